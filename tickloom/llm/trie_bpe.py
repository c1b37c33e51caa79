"""BPE encoding and decoding by prefix sharing.

The distinct words of a batch are put in a trie (held implicitly: sorted words visit it depth first, and the path to
the current node is a stack). For every prefix one thing is enough: the last token of its encoding. Token ``t`` ends
the encoding of a prefix exactly if ``t`` is a suffix of it and the last token ``u`` of what stands before is
*stable* beside ``t``: merging the symbols of ``u + t`` by rank gives ``u, t`` again. So each trie edge costs a few
lookups, and prefixes that words share are encoded once.

Defined results: a null text counts as empty; an empty text has no ids and decodes to ""; rows are independent, so
repeated rows give repeated results; texts are never cut, whatever their length.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import ahocorasick
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .arrow import map_texts, text_rows
from .chunks import LONGEST, blank_runs, lowered, word_and_marks

END = "</w>"
#: One character in place of the end mark while suffixes are looked up.
MARK = "\uffff"
#: Latin letters up to U+024F and ASCII: composed already, with lower case of their own.
PLAIN = re.compile("[!-~\u00a1-\u024f]*")
#: The word splitter that the vocabulary file names; a file with another one is refused.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Text bytes whose runs are held at a time.
SLICE = 1 << 20


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 as is, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encoder for a vocabulary of words with an end mark, read from a tokenizers JSON file."""

    #: Distinct runs that are remembered; beyond it the encoder starts afresh. Long ones never are.
    KEPT = 400_000
    #: Pairs of tokens whose border is remembered.
    BORDERS = 1_000_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or split != SPLIT or model.get("ignore_merges") or spec.get("decoder"):
            raise ValueError(f"{path}: not a word-end BPE vocabulary of the kind this encoder knows")
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        #: token -> (left part, right part, rank of its merge); symbols have none.
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, t = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.rank[a, b] = r
            self.parts[t] = (a, b, r)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.suffixes = ahocorasick.Automaton()
        for t, i in self.vocab.items():
            whole = t.endswith(END)
            own = t.removesuffix(END)
            self.suffixes.add_word(own + MARK * whole, (i, len(own), int(whole)))
        self.suffixes.make_automaton()
        self.library = Tokenizer.from_file(path)
        self.words = regex.compile(SPLIT)
        self.stand_in = {b: c for b, c in byte_alphabet().items()}
        self.stable: dict[tuple[int, int], bool] = {}
        self.spoken = {i: f"{t} ".encode() for i, t in self.names.items()}
        #: Run -> value, see ``learn``; words and marks that make up a run are runs as well.
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.long: list[str] = []

    # -- the trie walk ----------------------------------------------------------------------------------------

    def beside(self, u: int, t: int) -> bool:
        """True if no merge crosses the border while the symbols of ``u + t`` are merged by rank, leftmost first."""
        known = self.stable.get((u, t))
        if known is not None:
            return known
        # The pieces at the border, from whole tokens back to symbols; each lives until its whole is made.
        far = 1 << 60
        a, a_until, b, b_until = u, far, t, far
        ok = True
        while True:
            r = self.rank.get((a, b))
            if r is not None and r < a_until and r <= b_until:
                ok = False
                break
            made_a = self.parts[a][2] if a in self.parts else -1
            made_b = self.parts[b][2] if b in self.parts else -1
            if made_a < 0 and made_b < 0:
                break
            # Undo what was made last. Of equal ranks the right one was made later.
            if made_a > made_b:
                a, a_until = self.parts[a][1], made_a
            else:
                b, b_until = self.parts[b][0], made_b
        if len(self.stable) > self.BORDERS:
            self.stable.clear()
        self.stable[u, t] = ok
        return ok

    def alone(self, t: int) -> bool:
        """True if the symbols of ``t`` merge to ``t`` itself; its two parts must be so and stable until it is made."""
        if t not in self.parts:
            return True
        a, b, r = self.parts[t]
        key = (-1, t)
        if key not in self.stable:
            self.stable[key] = self.alone(a) and self.alone(b) and self.joined(a, b, r)
        return self.stable[key]

    def joined(self, u: int, t: int, by: int) -> bool:
        """True if the merge of rank ``by`` joins ``u`` and ``t`` and no other merge crosses their border before."""
        a, a_until, b, b_until = u, by, t, by
        while True:
            r = self.rank.get((a, b))
            if r is not None and (a, b) != (u, t) and r < a_until and r <= b_until:
                return False
            made_a = self.parts[a][2] if a in self.parts else -1
            made_b = self.parts[b][2] if b in self.parts else -1
            if max(made_a, made_b) > by:
                return False
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                a, a_until = self.parts[a][1], made_a
            else:
                b, b_until = self.parts[b][0], made_b

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of each distinct word (byte stand-ins, no end mark), by one depth-first walk over their trie."""
        out: dict[str, tuple[int, ...]] = {}
        token, length, path = [0], [0], ""  # of each prefix of the path, the last token and its length
        beside, alone, suffixes, stable = self.beside, self.alone, self.suffixes.iter, self.stable
        for word in sorted(set(words)):
            n, shared, most = len(word), 0, min(len(path), len(word) - 1)
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del token[shared + 1 :], length[shared + 1 :]
            path, final = word[: n - 1], None
            for stop, (t, k, whole) in suffixes(word + MARK):
                at = stop + 1 - whole
                if len(token) != at if not whole else final:
                    continue  # its prefix is encoded already
                before = at - k
                if before:
                    ok = stable.get((token[before], t))
                    if ok is None:
                        ok = beside(token[before], t)
                else:
                    ok = alone(t)
                if not ok:
                    continue
                if whole:
                    final = (t, before)
                elif at < n:
                    token.append(t)
                    length.append(k)
            if final is None:
                raise ValueError(f"no token ends {word!r}")
            t, at = final
            ids = [t]
            while at:
                ids.append(token[at])
                at -= length[at]
            ids.reverse()
            out[word] = tuple(ids)
        return out

    # -- texts ------------------------------------------------------------------------------------------------

    def split(self, run: str) -> list[str]:
        """The words of a run that holds no special string, as byte stand-ins."""
        if not PLAIN.fullmatch(run):  # letters and blanks as the library's version of Unicode has them
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(run))]
        s = self.stand_in
        return ["".join([s[b] for b in w.encode()]) for w in self.words.findall("".join([c.lower() for c in run]) if "İ" in run else run.lower())]

    def spell(self, word: str) -> str:
        return word if word.isascii() else "".join([self.stand_in[b] for b in word.encode()])

    def value(self, ids) -> tuple[bytes, bytes]:
        return array("I", ids).tobytes(), b"".join([self.spoken[i] for i in ids])

    def learn(self, runs: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """Values of all ``runs`` (and of others): their ids as bytes, their tokens in UTF-8 with a blank after each.

        What isn't remembered is encoded together, in one walk. The values hold until the next call.
        """
        known = self.known
        for run in self.long:
            del known[run]
        if len(known) > self.KEPT:
            known.clear()
        new = runs.difference(known)
        self.long = [r for r in new if len(r) > LONGEST]
        words: set[str] = set()
        marked: list[tuple[str, str, str]] = []
        odd: list[tuple[str, list[int | str]]] = []
        spelt: set[str] = set()  # words as byte stand-ins
        for run in new:
            own = word_and_marks(run)
            if own is not None:
                words.add(own[0])
                if own[1]:
                    words.add(own[1])
                    marked.append((run, *own))
                continue
            parts: list[int | str] = []
            for piece in self.special_split.split(run) if "<|" in run else (run,):
                if piece in self.special:
                    parts.append(self.special[piece])
                elif piece:
                    parts += self.split(piece)
            odd.append((run, parts))
            spelt.update([x for x in parts if not isinstance(x, int)])
        words.difference_update(known)
        spelling = {w: self.spell(w) for w in words}
        spelt.update(spelling.values())
        fresh = {w: self.value(ids) for w, ids in self.encode_words(list(spelt)).items()}
        for word, own in spelling.items():
            known[word] = fresh[own]
        for run, word, marks in marked:
            (a, b), (c, d) = known[word], known[marks]
            known[run] = a + c, b + d
        for run, parts in odd:
            values = [self.value([x]) if isinstance(x, int) else fresh[x] for x in parts]
            known[run] = b"".join([v[0] for v in values]), b"".join([v[1] for v in values])
        return known

    def encode_runs(self, runs: list[str]) -> list[tuple[int, ...]]:
        """Ids of each run between blanks."""
        known = self.learn(set(runs))
        return [tuple(array("I", known[r][0])) for r in runs]

    def decode(self, ids) -> str:
        """As a tokenizer without a decoder does: the tokens' own strings with a blank between."""
        return " ".join([self.names[i] for i in ids])


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and with ``keep_ids`` also ``ids`` (array<int>) and
    ``decoded``. Hashes are of the ids as little-endian 32-bit integers and of the decoded text in UTF-8.
    """
    extra = ", ids array<int>, decoded string" if keep_ids else ""

    def make():
        bpe = WordBpe(tokenizer_path)

        def work(_, texts):
            split = [blank_runs(lowered(t)) for t in texts]
            known = bpe.learn(set().union(*split))
            n, ids_hash, text_hash, all_ids, all_text = [], [], [], [], []
            for runs in split:
                values = [known[r] for r in runs]
                ids = b"".join([v[0] for v in values])
                text = b"".join([v[1] for v in values])[:-1]
                n.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(text).hexdigest())
                if keep_ids:
                    all_ids.append(array("i", ids).tolist())
                    all_text.append(text.decode())
            return [n, ids_hash, text_hash, *([all_ids, all_text] if keep_ids else [])]

        return work

    out = map_texts(text_rows(docs, id_col, text_col), f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}", make, SLICE)
    return out
