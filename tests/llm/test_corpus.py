"""Operators that look at the whole corpus, against plain versions."""

import os
import re
import zlib
from collections import Counter
from contextlib import contextmanager

import numpy as np
import pytest
import xxhash
from conftest import prose
from pyspark.sql import functions as F
from tickloom.llm import decontaminate, golay, line_templates, near_dup, quality, store, toxicity, wrappers

SF = "/root/testdata/sf0.001"


def plain_print(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), seed=42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def classes(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    own = list(root)
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {p: find(p) for p in own}


def test_golay_keys():
    r = np.random.default_rng(0)
    for k in range(5):
        x = r.integers(0, 2**64, 500, dtype=np.uint64)
        y = x.copy()
        for i in range(len(y)):
            for b in r.choice(64, k, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        sets = []
        for z in (x, y):
            keys, rows = near_dup.golay_keys(z.view(np.int64))
            s = [set() for _ in z]
            for key, row in zip(keys.tolist(), rows.tolist()):
                s[row].add(key)
            sets.append(s)
        assert all(a & b for a, b in zip(*sets))
    words = np.arange(1 << 12) * 2047
    assert ((golay.home(words) >= 0) & (golay.home(words) < 4096)).all()


def test_near_duplicates(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = {t: plain_print(t) for _, t in rows}
    root = classes(set(prints.values()))
    least = {}
    for d, t in rows:
        c = root[prints[t]]
        if d is not None:
            least[c] = min(d, least.get(c, d))
    want = sorted((str(d), f"{prints[t]:016x}", least.get(root[prints[t]])) for d, t in rows)
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in near_dup.near_duplicates(docs).collect())
    assert got == want
    assert near_dup.near_duplicates(empty).count() == 0
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(set(least.values())) and ids.count(None) == 2


def test_near_duplicates_one_id(spark):
    a, b = "a b c d e f", "x y z u v w q r"
    rows = [(1, a), (1, b), (0, a), (1, b), (None, a), (2, b), (3, None), (4, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.lit("clash"))
    for limit in (store.BROADCAST_ROWS, 0):
        with small_broadcasts(limit):
            got = near_dup.drop_near_duplicates(d)
            assert got.columns == d.columns
            # The second text of document 1 is no copy of document 0's; of null and empty texts the first stays.
            assert sorted(map(str, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(str, [(0, a), (1, b), (None, a), (3, None)]))


def test_line_templates_clash(spark):
    d = spark.createDataFrame([(1, "one two three"), (2, "one two three\nfour five six")], "doc_id long, text string").withColumn("_lines", F.lit(5)).withColumn("_row", F.lit(6))
    got = line_templates.drop_lines(d)
    assert got.columns == d.columns and sorted(map(tuple, got.collect())) == [(1, "one two three", 5, 6), (2, "four five six", 5, 6)]


def test_scratch(spark):
    with store.scratch(spark) as keep:
        gone = store.written(spark.range(3).toDF("i"), "gone")
        kept = keep(store.written(gone, "kept"))
    assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|PATH_NOT_FOUND|FAILED_READ_FILE"):
        spark.read.parquet(gone.inputFiles()[0]).count()


def test_large_bucket():
    r = np.random.default_rng(3)
    base = np.uint64(r.integers(0, 2**63))
    fp = np.unique(np.array([base ^ np.uint64(sum(1 << int(b) for b in r.choice(64, r.integers(0, 7), replace=False))) for _ in range(1500)], np.uint64))
    want = classes(fp.tolist())
    for limit in (100, 10**6):
        near_dup.LARGE, old = limit, near_dup.LARGE
        links = near_dup.forest(fp)
        near_dup.LARGE = old
        root = {p: p for p in fp.tolist()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            for x, y in zip(a.tolist(), b.tolist()):
                assert (x ^ y).bit_count() <= 4
                root[find(x)] = find(y)
        assert len({find(p) for p in root}) == len(set(want.values()))


def test_line_templates(spark, docs, empty):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(5, f"kept line of five 1\n{long}\nshort one"), (7, f"kept line of five 22\n{long.replace('kappa', 'other')}\nshort one\nnew words stand here"), (9, f"{long.replace('kappa', 'other').replace('alpha', 'first')}\nNEW words stand here"), (None, "new words stand here"), (2, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_templates.dedup_lines(d).collect()}
    assert got[5] == rows[0][1] and got[7] == "short one\nnew words stand here" and got[9] == rows[2][1].split("\n")[0] and got[None] == "" and got[2] == ""
    out = line_templates.drop_lines(docs)
    assert out.columns == docs.columns and all(r.n_chars in (None, len(r.text)) for r in out.collect() if r.text)
    assert line_templates.dedup_lines(empty).count() == 0 and line_templates.drop_lines(empty).count() == 0


def test_line_templates_sql(spark):
    import duckdb
    import pandas as pd

    texts = [prose(i % 6, 120, 12).replace("river", f"river{i}") if i % 2 else prose(i, 90, 11) for i in range(24)]
    documents = pd.DataFrame({"doc_id": range(24), "text": texts})
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(con.execute(line_templates.ORACLE).fetchall())
    d = line_templates.dedup_lines(spark.createDataFrame(documents))
    got = sorted(tuple(r) for r in d.select("doc_id", F.col("_lines.all"), F.col("_lines.dropped"), "text").collect())
    assert got == want and sum(r[2] for r in want) > 20


def plain_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(g)
    covered = {i + k for i, x in enumerate(g) if c[x] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(docs, empty):
    want = sorted((str(r.doc_id), *plain_counts(r.text)) for r in docs.collect())
    rows = quality.quality(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert all(not (r.kept and r.base_failed) for r in rows)
    assert quality.quality(empty).count() == 0 and quality.drop_poor(empty).count() == 0
    assert quality.drop_poor(docs).columns == docs.columns


def test_quality_outliers(spark):
    clean = [(i, prose(i, 60 + i % 200), "en", f"s{i % 2}") for i in range(600)]
    junk = [(1000 + i, " ".join(w + "###" for w in prose(i, 90).split()), "en", "s0") for i in range(40)]
    d = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    rows = {r.doc_id: r for r in quality.quality(d).collect()}
    assert not any(rows[i].kept for i in range(1000, 1040))
    assert sum(rows[i].kept for i in range(600)) >= sum(not rows[i].base_failed for i in range(600)) - 2
    assert {r.doc_id for r in quality.drop_poor(d).collect()} == {i for i, r in rows.items() if r.kept}
    assert abs(quality.chi_square_cdf(6.6257, 5) - 0.75) < 1e-4


def plain_mcd(x, starts=60):
    """Least determinant over random starts, exact quantiles, the operator's floors."""
    r = np.random.default_rng(0)
    floors, h, scale = np.array(quality.FLOORS), int(np.ceil(quality.SHARE * len(x))), quality.consistency(quality.SHARE, quality.P)

    def estimate(rows):
        m = rows.mean(axis=0)
        return m, np.cov(rows.T, bias=True) * scale + np.diag(floors)

    best = None
    for _ in range(starts):
        m, c = estimate(x[r.choice(len(x), 2 * quality.P, replace=False)])
        for _ in range(30):
            off = x - m
            d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(c), off)
            m, c = estimate(x[np.argsort(d, kind="stable")[:h]])
        found = np.linalg.slogdet(c)[1]
        if best is None or found < best[0]:
            best = found, m, c
    return best


def test_quality_estimates(spark):
    r = np.random.default_rng(7)
    groups = {}
    for name, share in (("clean", 0.0), ("dirty", 0.2)):
        x = r.normal(size=(800, quality.P)) @ np.triu(r.normal(size=(quality.P, quality.P)) * 0.4 + np.eye(quality.P))
        bad = int(share * len(x))
        x[:bad] = r.normal(size=(bad, quality.P)) * 0.1 + 8  # a tight clump, which hides from plain covariances
        groups[name] = x
    rows = [(g, "s", *map(float, v)) for g, x in groups.items() for v in x]
    d = spark.createDataFrame(rows, "g_lang string, g_source string, " + ", ".join(f"{c} double" for c in quality.X))
    found = {row.g_lang: row for row in quality.estimates(d, ["g_lang", "g_source"]).collect()}
    for g, x in groups.items():
        want, m, c = plain_mcd(x)
        assert abs(found[g].log_det - want) < 0.1
        got = np.array([found[g][k] for k in quality.M])
        factor = np.zeros((quality.P, quality.P))
        for (i, j), k in quality.L.items():
            factor[i, j] = found[g][k]
        assert np.abs(got - m).max() < 0.1
        far = ((x - got) @ factor.T) ** 2
        off = x - m
        assert np.corrcoef(far.sum(axis=1), np.einsum("ij,jk,ik->i", off, np.linalg.inv(c), off))[0, 1] > 0.999
    # By a table: the upper tail of chi-square with six degrees is 0.001 at 22.458.
    assert abs(quality.chi_square_quantile(0.999, 6) - 22.458) < 0.01 and 50 < quality.CUTOFF < 70


def test_decontamination(spark, docs, empty):
    items = [(1, "If Alice has 12 apples and gives 5 apples to Bob then how many apples remain with Alice after 3 days"), (2, prose(3, 61).split("\n")[0]), (3, None), (4, "two words"), (None, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        "So: If Carol has 40 apples and gives 9 apples to Dave then how many apples remain with Carol after 7 days. End",
        "If Carol has 40 apples and gives 40 apples to Carol then how many apples remain with Dave after 7 days",
        "it says two words here",
        None,
        prose(99, 200),
    ]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for limit in (store.BROADCAST_ROWS, 0):
        with small_broadcasts(limit):
            got = {r.doc_id: (r.contaminated, r.item_ids) for r in decontaminate.decontaminate(d, bench).collect()}
            assert got == {0: (True, [1]), 1: (False, []), 2: (True, [4]), 3: (False, []), 4: (False, [])}
            assert sorted(r.doc_id for r in decontaminate.drop_contaminated(d, bench).collect()) == [1, 3, 4]
    assert decontaminate.drop_contaminated(docs, bench).columns == docs.columns
    assert decontaminate.decontaminate(empty, bench).count() == 0 and not decontaminate.decontaminate(d, bench.where("false")).where("contaminated").count()


@contextmanager
def small_broadcasts(limit):
    """Beyond ``limit`` rows, the way without a broadcast; a filter small enough to err."""
    old = store.BROADCAST_ROWS, store.FILTER_WORDS
    store.BROADCAST_ROWS = decontaminate.BROADCAST_ROWS = limit
    store.FILTER_WORDS = 4
    yield
    store.BROADCAST_ROWS, store.FILTER_WORDS = old
    decontaminate.BROADCAST_ROWS = old[0]


def leaked(item, text):
    found = decontaminate.compare(item, text)
    return {0: found} if found else {}


def test_decontamination_slots_at_the_end():
    item = "What is 45 + 67 + 89 + 12 + 33?"
    assert leaked(item, f"Now then. {item} End") == {0: (1.0, 0)}
    assert leaked(item, "What is 5 + 6 + 7 + 8 + 9?") == {0: (1.0, 5)}
    assert leaked(item, "What is 5 + 6 + 7 and more") == {} and leaked(item, "it is 5 + 5 + 7 + 8 + 9") == {}
    tail = "Sort these numbers from least to greatest 9 4 7 1 3 8"
    assert leaked(tail, "x. " * 50 + tail) == {0: (1.0, 0)} and leaked(tail, tail[:-8]) == {}


def test_decontamination_places():
    item = "If Alice has 12 apples and gives 5 apples to Bob then how many does she keep"
    variant = "If Carol has 40 apples and gives 40 apples to Carol then how many does she keep."
    copy = "If Carol has 40 apples and gives 9 apples to Dave then how many does she keep."
    short = "If Alice has 12 apples and gives 5 pears to Bob"
    assert leaked(short, "If Carol has 40 apples and gives 40 pears to Carol. " * 3) == {}
    for text in (short, "If Dave has 30 apples and gives 7 pears to Carol"):
        assert 0 in leaked(short, "If Carol has 40 apples and gives 40 pears to Carol. " * 3 + text)
    assert leaked(item, f"{variant} {item}") == {0: (1.0, 0)} and leaked(item, f"{variant} {copy}")[0][0] == 1.0
    # One word put in, after a variant.
    assert leaked(item, f"{variant} {item.replace('gives', 'gives just')}") == {0: (1.0, 0)}


def test_decontamination_far_apart():
    item = "one old keeper of the northern light walked down to see whether any boats had come back before the storm"
    words = item.split()
    pieces = [" ".join(words[i : i + 5]) for i in range(0, len(words), 5)]
    assert leaked(item, f" {prose(5, 30)} ".join(pieces)) == {} and leaked(item, " and then ".join(reversed(pieces))) == {}
    assert 0 in leaked(item, " truly ".join(pieces))


def test_decontamination_rows(spark):
    items = [prose(i, 30) for i in range(6)]
    bench = spark.createDataFrame([*enumerate(items), (None, items[0])], "item_id long, text string")
    texts = [(7, items[0]), (7, f"{items[1]}. {items[2]}"), (7, "nothing of it"), (None, items[3]), (None, ""), (None, items[3]), (8, " and ".join(items))]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    want = [(7, True, [0, None]), (7, True, [1, 2]), (7, False, []), (None, True, [3]), (None, False, []), (None, True, [3]), (8, True, [0, 1, 2, 3, 4, 5, None])]
    for limit in (store.BROADCAST_ROWS, 0):
        with small_broadcasts(limit):
            got = [tuple(r)[:3] for r in decontaminate.decontaminate(d, bench).collect()]
            assert sorted(map(str, got)) == sorted(map(str, want))
            assert decontaminate.drop_contaminated(d.withColumn("_filter", F.lit(1)).withColumn("key", F.lit(2)), bench).count() == 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_decontamination_plain(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = set()
    for d in docs.collect():
        found = [(i, v) for i, t in items if (v := decontaminate.compare(t, d.text or ""))]
        want.add((d.doc_id, bool(found), str(sorted(i for i, _ in found)), max((v[0] for _, v in found), default=0.0), sum(v[1] for _, v in found)))
    assert {(r.doc_id, r.contaminated, str(r.item_ids), r.containment, r.slots_changed) for r in decontaminate.decontaminate(docs, bench).collect()} == want
    assert any(w[1] for w in want)


def test_toxicity(spark, docs, empty):
    bad = ["grumblork", "snarfwit", "blatherskate"]
    rows = [(i, prose(i, 60) + (f" {bad[i % 3]} {prose(i + 1, 5)} you {bad[(i + 1) % 3]} here" if i % 4 == 0 else "")) for i in range(600)]
    d = spark.createDataFrame([*rows, (None, None), (9999, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(d, labels).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (i in set(held)) for i in range(600))
    assert sum(got[i].predicted == int(i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert 0 <= got[None].score <= 1 and got[9999].predicted == 0
    assert toxicity.score(docs, labels.where("false")).count() == docs.count() and toxicity.score(empty, labels).count() == 0


def test_label_model():
    r = np.random.default_rng(2)
    toxic = r.random(400) < 0.3
    votes = np.stack([r.random(400) < np.where(toxic, a, b) for a, b in ((0.7, 0.05), (0.5, 0.02), (0.1, 0.1))], axis=1)
    votes = np.concatenate([votes, votes[:, :1]], axis=1).astype(float)  # the last voter says what the first does
    labels = np.where(r.random(400) < 0.5, np.where(r.random(400) < 0.05, ~toxic, toxic), -1)
    post, model, seen = toxicity.label_model(votes, labels, np.ones(400))
    assert all(b >= a - 1e-9 * abs(a) for a, b in zip(seen, seen[1:]))
    assert model.parent[0] == 3 or model.parent[3] == 0
    # Every row by the plain formula.
    for i in range(400):
        p = []
        for c, prior in ((0, 1 - model.prior), (1, model.prior)):
            for j in range(4):
                up = model.parent[j]
                rate = model.rates[c, int(up >= 0 and votes[i, up] > 0), j]
                prior *= rate if votes[i, j] else 1 - rate
            prior *= {1: model.given[c], 0: 1 - model.given[c], -1: 1.0}[int(labels[i])]
            p.append(prior)
        assert abs(p[1] / sum(p) - post[i]) < 1e-6
    # A copied voter brings no evidence of its own.
    once, _, _ = toxicity.label_model(votes[:, :3], labels, np.ones(400))
    assert np.abs(once - post).max() < 0.05 and ((post > 0.5) == toxic)[labels >= 0].mean() > 0.9


def test_toxicity_repeated_rows(spark):
    rows = [(i % 50, prose(i % 50, 40) + (" you utter grumblork snarfwit" if i % 50 % 3 == 0 else "")) for i in range(200)]
    d = spark.createDataFrame([*rows, (3, "another text of document 3")], "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("toxic", F.lit("y"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(50)] * 2 + [(1, None), (None, 1)], "doc_id long, toxic int")
    toxic, clean, _ = toxicity.training_rows(d, labels)
    assert len(toxic) + len(clean) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(50))
    out = toxicity.score(d, labels).collect()
    assert len(out) == 201 and len({(r.doc_id, r.score) for r in out}) <= 51


PAGE = '<html><head><title>t</title><script>var a="</p>";</script></head><body><header class="site">Site</header><nav><ul><li><a href="/">x</a></li><li><a href="/b">y</a></li></ul></nav><div class="ad">Buy {k}</div>{body}<div class="comments"><p>nice {k}</p></div><footer>&copy; f</footer></body></html>'


def test_wrappers(spark):
    article = [f"<article><h1>Head {k}</h1><p>First  &amp; <b>bold{k}</b> text.<br><p>Second {k}.<aside>side</aside><form>f</form><ul><li>one {k}</li><li>two</li></ul></article>" for k in range(5)]
    plain = [f'<div id="wrap"><div class="content"><h1>Head {k}</h1><p>{"long text here " * 9}{k}</p><p>{"more words " * 9}{k}</p></div><div class="sidebar"><p>links</p></div></div>' for k in range(5)]
    rows = [(k, f"http://a.example/{k}", PAGE.replace("{k}", str(k)).replace("{body}", b)) for k, b in enumerate(article)]
    rows += [(10 + k, f"https://www.b.example/{k}", PAGE.replace("{k}", str(k)).replace("{body}", b)) for k, b in enumerate(plain)]
    rows += [(20, None, None), (21, "odd", "<p>x < y<b"), (22, "http://a.example/9", ""), rows[0]]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {}
    for bound in (wrappers.WRAPPER_BYTES, -1):
        wrappers.WRAPPER_BYTES, old = bound, wrappers.WRAPPER_BYTES
        out = wrappers.main_text(d).collect()
        wrappers.WRAPPER_BYTES = old
        assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
        now = {r.page_id: r.text for r in out}
        assert not got or got == now
        got = now
    assert got[2] == "Head 2\nFirst & bold2 text.\nSecond 2.\none 2\ntwo"
    assert got[12] == f"Head 2\n{('long text here ' * 9)}2\n{('more words ' * 9)}2".replace("  ", " ")
    assert got[20] == "" and got[22] == ""
    assert wrappers.main_text(d.where("false")).count() == 0


def wrapped(spark, pages):
    d = spark.createDataFrame([(k, u, h) for k, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    got = []
    for bound in (wrappers.WRAPPER_BYTES, -1):
        wrappers.WRAPPER_BYTES, old = bound, wrappers.WRAPPER_BYTES
        got.append({r.page_id: r.text for r in wrappers.main_text(d).collect()})
        wrappers.WRAPPER_BYTES = old
    assert got[0] == got[1]
    return [got[0][k] for k in range(len(pages))]


def test_wrappers_templates(spark):
    def page(kind, k):
        text = f"<h2>Head {k}</h2><p>{prose(k, 40)}</p><p>{prose(100 + k, 30)}</p>"
        return "<body><div class='info'><p>" + "Same words on every page of it. " * 3 + f"</p></div><{kind}>{text}</{kind.split()[0]}></body>"

    def want(k):
        return f"Head {k}\n{' '.join(prose(k, 40).split())}\n{' '.join(prose(100 + k, 30).split())}"

    kinds = ["article", "article", "div class='content'", "div class='content'", "div class='content'", "div class='post'", "div class='once'"]
    for urls in (["http://c.example/%d"] * 7, ["http://m.c.example/%d", "http://www.c.example/%d"] * 3 + ["http://c.example/%d"], ["/odd/%d"] * 6 + [None]):
        got = wrapped(spark, [(u and u % k if u and "%" in u else u, page(kind, k)) for k, (u, kind) in enumerate(zip(urls, kinds))])
        assert got == [want(k) for k in range(7)]
    # A short text beside a long one that all pages of the host have: a template of its own, with one page.
    short = page("div class='content'", 50).replace(prose(50, 40), "Few words").replace(prose(150, 30), "and fewer")
    assert wrapped(spark, [("http://c.example/", page("div class='content'", k)) for k in range(3)] + [("http://c.example/", short)])[3] == "Head 50\nFew words\nand fewer"


def test_wrappers_copies(spark):
    one = "<body><h1>Only heading</h1><p>The only words of this page.</p></body>"
    quote = "<body><article><h1>Head {k}</h1><p>Words {k} of it.</p><h3>Summary</h3><p>More {k}.</p>{quote}</article></body>"
    said = quote.replace("{k}", "9").replace("{quote}", "<blockquote>Said once.</blockquote>")
    pages = [("http://d.example/", one)] * 3 + [("http://e.example/", quote.replace("{k}", str(k)).replace("{quote}", "")) for k in range(3)] + [("http://e.example/9", said)] * 3
    # Pages that differ in nothing that is read.
    pages += [("http://f.example/", one.replace("<body>", f"<body><nav>{k}</nav>")) for k in range(2)]
    got = wrapped(spark, pages)
    assert got[:3] == got[9:] + got[9:10] == ["Only heading\nThe only words of this page."] * 3
    assert got[3:6] == [f"Head {k}\nWords {k} of it.\nSummary\nMore {k}." for k in range(3)]
    assert got[6:9] == ["Head 9\nWords 9 of it.\nSummary\nMore 9.\nSaid once."] * 3


def test_wrappers_depth():
    for deep in ("<div>" * 70 + "<p>deep</p>" + "</div>" * 70, "<font>" * 70 + "<div><p>deep</p></div>" + "</font>" * 70, "<div>" * 54 + "<ul><li>" * 5 + "deep" + "</li></ul>" * 5 + "</div>" * 54, "<div>" * 56 + "<table><tr><td>x</p></b>deep</td></tr></table>" * 2 + "</div>" * 56, "<div>" * 54 + "<b>" * 9 + "<div>deep</div>" + "</div>" * 54):
        root = wrappers.parse(f"<html><body><div><article><p>before</p>{deep}<p>after</p><p>last</p></article><p>outside</p></div></body></html>")
        body = root.kids[0].kids[0]
        assert [k.tag for k in body.kids] == ["div"] and [k.tag for k in body.kids[0].kids] == ["article", "p"]
        article = body.kids[0].kids[0]
        spec = '{"regions": ["//html/body/div/article"], "skip": []}'
        text = wrappers.Reader(spec).read(root, wrappers.slots(root)).split("\n")
        assert text[0] == "before" and text[-2:] == ["after", "last"] and "deep" in "".join(text) and article.tag == "article"


def test_wrappers_keep(spark):
    """What earlier versions lost."""
    pages = [
        ('<body class="has-sidebar"><div class="page with-menu"><article><h1>A</h1><p>text {k}</p><h3>Summary</h3></article><div class="sidebar"><p>no</p></div></div></body>', "A\ntext {k}\nSummary"),
        ('<article id="post-search-1"><p>text {k} <math>x+1</math></p></article>', "text {k} x+1"),
        ('<form id="all"><article><header><h1>A</h1></header><p>text {k}</p><form>no</form></article></form>', "A\ntext {k}"),
        ('<article><p>text {k}</p></article><div class="comments"><article class="comment"><p>no {k}</p></article></div>', "text {k}"),
        ('<article class="comment"><p>only {k}</p></article>', "only {k}"),
        ("<body>" + "<div>" * 80 + "<nav>no</nav><p>yes {k}</p>" + "</div>" * 80 + "</body>", "yes {k}"),
    ]
    rows = [(f"http://h{i}.example/{k}", html.replace("{k}", str(k))) for i, (html, _) in enumerate(pages) for k in range(3)]
    assert wrapped(spark, rows) == [text.replace("{k}", str(k)) for _, text in pages for k in range(3)]


def test_wrappers_need_the_host(spark):
    """Regions that no page shows by itself: the wrapper of all pages of the host decides."""
    info = "<div class='info'><p>" + "Same words on every page of it, and many more of them than the rest has. " * 3 + "</p></div>"
    changing = [f"<body>{info}<div class='text'><p>Few words {k}.</p><p>And some {k} more.</p></div></body>" for k in range(4)]
    got = wrapped(spark, [("http://g.example/", p) for p in changing])
    assert got == [f"Few words {k}.\nAnd some {k} more." for k in range(4)]
    # Teasers repeat on some pages, so they are a list where there is one of them as well.
    teasers = [f"<body><article class='post'><p>Post {k}.</p></article>" + f"<article class='card'><p>Card {k}</p></article>" * n + "</body>" for k, n in enumerate((1, 3, 2))]
    assert wrapped(spark, [("http://i.example/", p) for p in teasers]) == [f"Post {k}." for k in range(3)]
    alone = wrapped(spark, [("http://j.example/", changing[0]), ("http://k.example/", teasers[0])])
    assert alone[0].startswith("Same words") and alone[1] == "Post 0.\nCard 0"


def test_wrappers_linear():
    import time

    for page in ("<!" * 40_000, "<textarea/>" * 20_000, "<font>" * 20_000 + "<p>x" * 5_000, "<div>" * 20_000 + "x" + "</b>" * 20_000, "<a '" * 30_000, "<b><p>" * 8_000, "</x>" * 50_000):
        start = time.time()
        root = wrappers.parse(page)
        wrappers.slots(root)
        wrappers.skeleton(root)
        assert time.time() - start < 10


def plain_article(page):
    """Blocks of the article by patterns alone, for pages of plain paragraphs."""
    import html

    inner = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1].replace("<br>", " ")) if inner else []
    texts = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_wrappers_plain(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in wrappers.main_text(pages.withColumn("id", F.lit(1)).withColumn("host", F.lit(2))).collect()}
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()} and all(want.values())


def test_wrapper_alignment():
    one = wrappers.skeleton(wrappers.parse("<div><p>a</p><p>b</p><hr><h2>x</h2></div>"))
    two = wrappers.skeleton(wrappers.parse("<div><p>a</p><table><tr><td>1</td></tr></table><h2>x</h2></div>"))
    both = wrappers.merge(one, two)[3][0]
    assert [(n[0], n[1], n[2]) for n in both[3]] in ([("p", 0, 1), ("hr", 1, 0), ("table", 1, 0), ("h2", 0, 0)], [("p", 0, 1), ("table", 1, 0), ("hr", 1, 0), ("h2", 0, 0)])
    dl = wrappers.skeleton(wrappers.parse("<dl><dt>a</dt><dd>b</dd><dt>a</dt><dd>b</dd><dt>a</dt><dd>b</dd></dl>"))
    assert dl[3][0][3][0][0] == "()" and len(dl[3][0][3]) == 1


def test_pipeline(spark, tmp_path):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
    import corpus_pipeline

    base = [prose(i, 150) for i in range(8)]
    leak = "Which garden stands behind the silver mountain where seven quiet rivers meet the ancient harbour wall"
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*base, base[0], base[1] + "\nand one more line of it", base[2] + "\n" + leak, "too short"])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(range(8)) <= out and 8 not in out and 10 not in out and 11 not in out
