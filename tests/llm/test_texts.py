"""Operators that look at one text at a time, against the libraries and plain versions."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tickloom.llm import pii, token_blocks, token_counts, trie_bpe

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def ordered(df):
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def test_trie(docs, empty, library):
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in trie_bpe.encode_decode(docs, WORD).collect())
    want = []
    for d, t in ordered(docs):
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((str(d), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert trie_bpe.encode_decode(empty, WORD).count() == 0
    r = trie_bpe.encode_decode(docs, WORD, keep_ids=True).where("doc_id = 3").first()
    assert hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() == r.ids_sha256


def test_trie_on_words(library):
    import random

    r = random.Random(5)
    bpe = trie_bpe.WordBpe(WORD)
    vocab = list(bpe.vocab)
    runs = ["".join(r.choice(vocab).replace("</w>", "") for _ in range(r.randint(1, 4))) for _ in range(3000)] + ["".join(r.choice("aeb'é1-Éİ_…漢") for _ in range(r.randint(1, 9))) for _ in range(3000)] + ["a" * 500, "<|startoftext|>x", "abababab" * 9]
    runs = [x for x in runs if " " not in x]
    assert bpe.encode_runs(runs) == [tuple(e.ids) for e in library.encode_batch(runs, add_special_tokens=False)]


def test_blocks(docs, empty, library, tmp_path):
    rows = token_blocks.token_blocks(docs, WORD, path=str(tmp_path / "b")).collect()
    start, want = 0, []
    for d, t in ordered(docs):
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        want.append((d, len(ids), zlib.crc32(ids.tobytes())))
    got = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [w[0] for w in want]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(a), b, c) for a, b, c in want)
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert token_blocks.token_blocks(empty, WORD, path=str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 30_000])
def test_segment_round_trip(n):
    r = np.random.default_rng(n)
    ids = np.where(r.random(n) < 0.03, r.integers(0, 2**32, n), r.integers(500, 900, n)).astype(np.uint32)
    k = [n // 3, n - n // 3]
    s = token_blocks.Segment(token_blocks.write_segment([None, 7], np.array(k), ids))
    assert (s.ids() == ids).all() and s.doc_ids == [None, 7] and (s.document(0) == ids[: k[0]]).all() and (s.document(1) == ids[k[0] :]).all()


def test_counts(docs, empty):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, PIECE).collect())
    assert got == sorted((str(d), len(t.encode()), len(m.encode(t)), len(m.encode(t)) > 4096) for d, t in ordered(docs))
    assert token_counts.count_tokens(empty, PIECE).count() == 0
    c = token_counts.PieceCounts(PIECE)
    for t in ("", " ", "  ", "a ", " a", "a  b", "a\n\nb", "\n", "▁x", "a▁▁b", "<s> </s>", "\x00", "１　x"):
        assert sum(c.counts(c.runs(t))) == len(m.encode(t)), t


def plain_spans(x):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        g = re.sub("[^0-9]", "", m[0])
        if 14 <= len(g) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(g[::-1])) % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_pii_against_patterns():
    import random

    r = random.Random(2)
    parts = ["a@b.co", "x.y+z@q-r.st.uv", "@", "@@", "a@b", ".", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112", "+1 (980) 555-6268", "+", "+12", " ", "-", "é", "🙂", "79927398713", "007.0.0.1", "\n", "_d@e.f"]
    for _ in range(4000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_pii(spark, docs, empty):
    text = "Pay to IBAN DE89 3704 0044 0532 0130 00 or call 212-555-0182 today; token = abcdef0123456789abcdef01 and GB00 1234 5678 9012 3456 78"
    _, found = pii.find(text)
    assert [f[0] for f in found] == ["iban", "phone_local", "secret"] or [f[0] for f in found if f[0] != "card"] == ["iban", "phone_local", "secret"]
    assert pii.find("plain 212-555-0182 and nothing near")[1] == []
    rows = pii.digest(pii.find_pii(docs)).collect()
    assert len(rows) == docs.count() and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows if not r.spans)
    one = spark.createDataFrame([(1, "mail é a@b.co now")], "doc_id long, text string")
    r = pii.digest(pii.find_pii(one)).first()
    assert (r.n_email, r.spans, r.base_sha256) == (1, "email:7:13", pii.sha256_of([("email", 7, 13)]))
    assert pii.digest(pii.find_pii(empty)).count() == 0


def test_pii_checksum_vetoes():
    assert pii.find("my bank account GB00 1234 5678 9012 3456 78") == ([], [])
    good = "GB82 WEST 1234 5698 7654 32"
    for text in (f"iban {good}.", f"PAY {good} TO THE BANK", f"{good.replace(' ', '')} is the account"):
        (found,) = [f for f in pii.find(text)[1] if f[0] == "iban"]
        assert text[found[1] : found[2]].replace(" ", "") == good.replace(" ", "")


def test_pii_added_kinds():
    """Recall of the kinds that the method adds, on planted spans, and none where the context speaks of nothing."""
    import random

    def iban(r):
        body = "".join(r.choice("0123456789") for _ in range(18))
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    r = random.Random(4)
    made = {
        "iban": lambda: iban(r),
        "phone_local": lambda: f"{r.randint(200, 999)}-555-{r.randint(1000, 9999)}",
        "secret": lambda: "a1" + "".join(r.choice("0123456789abcdef") for _ in range(38)),
    }
    said = {"iban": "account {}", "phone_local": "call me at {}", "secret": 'token = "{}"'}
    for kind, make in made.items():
        hits = 0
        for _ in range(300):
            span = make()
            text = f"some words {said[kind].format(span)} and more words"
            at = text.index(span)
            hits += any(f[:3] == (kind, at, at + len(span)) for f in pii.find(text)[1]) or any(f[1] < at + len(span) and at < f[2] for f in pii.base_spans(text))
            if kind != "iban":
                assert not [f for f in pii.find(f"some words {span} and more words")[1] if f[0] == kind]
        assert hits >= 0.99 * 300, (kind, hits)
