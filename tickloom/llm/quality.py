"""Quality rules: two plain rules, then robust multivariate outliers per language and source.

Every text becomes counts and these a transformed vector (FEATURES). For each group of documents that pass the plain
rules the location and covariance of the SHARE of rows with the least determinant are looked for by concentration steps:
keep the SHARE of rows with the smallest distances, estimate from them, repeat. Three starts are taken EARLY steps
far, the one with the least determinant goes on until its determinant falls no more. Covariances get the factor that
makes them consistent for that share, and a floor on the diagonal, because several features are zero in most clean
texts. A document is rejected if its squared Mahalanobis distance is beyond the chi-square quantile of 1 - TAIL and it
lies in the direction of junk.

Starts, from medians and MADs of the group: the MADs alone; the products of the scaled rows cut down to length one
(spatial signs); the products of their hyperbolic tangents. Only the order of distances matters in a start.

All of it is DataFrame expressions: counts and windows of words come from array functions inside the row, estimates
from partial aggregates by group, the Cholesky factor from expressions on one row per group. No group is gathered;
what is kept between steps is one narrow row per document and one row per group and start.

Groups are (lang, source). Sources with fewer than LEAST passing documents are pooled by language, languages with
fewer in one pool; if that is still smaller, there is no estimate and the plain rules alone decide.

Defined results: a null text has no words (all counts 0, base_failed); null lang or source count as "". Rows are judged
alone given the estimates, so repeated rows get the same verdict. An empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .store import written

SHARE = 0.75
#: Steps of every start, and most steps in all.
EARLY, MOST = 2, 12
#: A step must bring the logarithm of the determinant down by this, or its start has settled.
SETTLED = 1e-3
LEAST = 200
#: Share of clean documents, were they normal, that lie beyond the cutoff: hardly one in a corpus of billions.
TAIL = 1e-10
#: Added to the variances of the features, in their order.
FLOORS = (0.15, 0.01, 0.06, 0.08, 0.12, 0.06)
FEATURES = ("log_words", "log_word_length", "symbols", "dup_lines", "repeats", "shouting")
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(df: DataFrame, text: Column, name: str = "_counts") -> DataFrame:
    """``df`` with a struct of the counts of ``text``."""
    taken = {c.lower() for c in df.columns}

    def fresh(stem: str) -> str:
        while stem.lower() in taken:
            stem += "_"
        taken.add(stem.lower())
        return stem

    body, words, windows, repeated, places = (fresh(f"_{x}") for x in ("body", "words", "windows", "repeated", "places"))
    keep = list(df.columns)
    df = df.withColumn(body, F.coalesce(text, F.lit("")))
    df = df.withColumn(words, F.array_remove(F.split(body, BLANKS), ""))
    n = F.size(words)
    df = df.withColumn(windows, F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))))
    # Only texts with a window that comes twice need places: windows in order, each beside its equals.
    df = df.withColumn(repeated, F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))

    def like(e: Column, i: Column) -> Column:
        return F.coalesce(e["w"] == F.get(repeated, i)["w"], F.lit(False))

    df = df.withColumn(places, F.sort_array(F.transform(F.filter(repeated, lambda e, i: like(e, i - 1) | like(e, i + 1)), lambda e: e["i"])))
    covered = F.aggregate(F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    joined = fresh("_joined")
    lined = fresh("_lines")
    df = df.withColumns({joined: F.array_join(words, ""), lined: lines})
    long = {
        "n_words": F.size(words),
        "word_chars": F.length(joined),
        "n_symbols": F.length(joined) - F.length(F.regexp_replace(joined, SYMBOLS, "")),
        "n_dup_lines": F.size(lined) - F.size(F.array_distinct(lined)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size(lined),
        "n_loud": F.length(F.regexp_replace(joined, "[^A-Z!]", "")),
    }
    return df.select(*[F.col(f"`{c}`") for c in keep], F.struct(*[v.cast("long").alias(k) for k, v in long.items()]).alias(name))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def vector(c: Column) -> list[Column]:
    """The transformed statistics, in the order of FEATURES. All grow with junk but the first two, which may go either way."""
    words, chars = F.greatest(c["n_words"], F.lit(1)).cast("double"), F.greatest(c["word_chars"], F.lit(1)).cast("double")
    share = lambda part, whole, scale: F.log1p(part * scale / whole)
    return [F.log1p(words), F.log(chars / words), share(c["n_symbols"], chars, 100), share(c["n_dup_lines"], F.greatest(c["n_lines"], F.lit(1)), 10), share(c["n_repeat_words"], words, 10), share(c["n_loud"], chars, 20)]


def chi_square_cdf(x: float, k: int) -> float:
    """By the series of the lower incomplete gamma function."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > 1e-15 * total:
        n += 1
        term *= z / (a + n)
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a))


def chi_square_quantile(share: float, k: int) -> float:
    low, high = 1e-9, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, k) < share else (low, mid)
    return low


def consistency(share: float, p: int) -> float:
    """What the covariance of the innermost ``share`` of a normal sample in ``p`` dimensions is to be multiplied by."""
    return share / chi_square_cdf(chi_square_quantile(share, p), p + 2)


P = len(FEATURES)
X = [f"x{i}" for i in range(P)]
M = [f"m{i}" for i in range(P)]
L = {(i, j): f"l{i}{j}" for i in range(P) for j in range(i + 1)}
#: Squared distance beyond which a document is an outlier.
CUTOFF = chi_square_quantile(1 - TAIL, P)


def distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance by the inverse factor in columns L; null without an estimate. One flat expression."""
    off = [x[i] - F.col(M[i]) for i in range(P)]
    return reduce(lambda a, b: a + b, [F.pow(reduce(lambda a, b: a + b, [F.col(L[i, j]) * off[j] for j in range(i + 1)]), F.lit(2.0)) for i in range(P)])


def with_factor(moments: DataFrame, scale: float, keys: list[str]) -> DataFrame:
    """Means and cross products (columns m_i, c_ij) -> means, the inverse Cholesky factor of the floored covariance, and the logarithm of its determinant."""
    # One select whose later columns read earlier ones, as text: a column at a time, the driver would analyse 42 plans.
    steps = []
    for i in range(P):
        for j in range(i + 1):
            cov = f"(c{i}{j} - {M[i]} * {M[j]}) * {scale!r}D"
            if i == j:
                cov = f"greatest({cov}, 0.0D) + {FLOORS[i]!r}D"
            inner = " - ".join([cov, *[f"f{i}{k} * f{j}{k}" for k in range(j)]])
            steps.append(f"sqrt(greatest({inner}, 1e-6D)) AS f{i}{j}" if i == j else f"({inner}) / f{j}{j} AS f{i}{j}")
    for i in range(P):
        for j in range(i + 1):
            known = " - ".join(["1.0D" if i == j else "0.0D", *[f"f{i}{k} * {L[k, j]}" for k in range(j, i)]])
            steps.append(f"({known}) / f{i}{i} AS {L[i, j]}")
    log_det = " + ".join(f"2 * ln(f{i}{i})" for i in range(P))
    return moments.selectExpr(*keys, *M, *steps, f"{log_det} AS log_det").select(*keys, *M, *L.values(), "log_det")


def groups(stats: DataFrame) -> DataFrame:
    """(lang, source) -> the group whose estimate it uses: itself, its language's pool, the pool of all, or none."""
    own = stats.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST
    by_lang = own.where(small).groupBy("lang").agg(F.sum("n").alias("lang_n"))
    rest = by_lang.where(F.col("lang_n") < LEAST).agg(F.coalesce(F.sum("lang_n"), F.lit(0)).alias("rest_n"))
    df = own.join(by_lang, "lang", "left").join(rest)
    level = F.when(~small, 0).when(F.col("lang_n") >= LEAST, 1).when(F.col("rest_n") >= LEAST, 2).otherwise(3)
    return df.select("lang", "source", F.when(level < 2, F.concat(F.lit("="), "lang")).otherwise("*").alias("g_lang"), F.when(level == 0, F.concat(F.lit("="), "source")).otherwise("*").alias("g_source"), (level < 3).alias("g_known"))


def fit(stats: DataFrame) -> DataFrame:
    """``lang, source`` with the estimate that holds for them. ``stats``: lang, source, counts, one row per document."""
    rows = stats.where(~base_failed(F.col("counts"))).select("lang", "source", *[v.alias(x) for v, x in zip(vector(F.col("counts")), X, strict=True)])
    rows = written(rows, "quality-vectors")
    named = written(groups(rows), "quality-groups")
    dealt = rows.join(named.where("g_known"), ["lang", "source"]).select("g_lang", "g_source", *X)
    params = written(estimates(dealt, ["g_lang", "g_source"]), "quality-fitted")
    return named.join(params, ["g_lang", "g_source"], "left").select("lang", "source", *M, *L.values())


def sums(rows: DataFrame, keys: list[str], x: list[Column]) -> DataFrame:
    """Means and mean products."""
    return rows.groupBy(*keys).agg(*[F.avg(v).alias(m) for v, m in zip(x, M, strict=True)], *[F.avg(x[i] * x[j]).alias(f"c{i}{j}") for i, j in L])


def starts(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """Estimates to begin with, a row per group and ``g_start``."""
    middle = written(dealt.groupBy(*keys).agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"o{i}") for i, x in enumerate(X)]), "quality-medians")
    off = dealt.join(middle, keys)
    spread = off.groupBy(*keys).agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"o{i}")), 0.5, 1000).alias(f"s{i}") for i, x in enumerate(X)])
    scale = [F.sqrt(F.pow(1.4826 * F.col(f"s{i}"), F.lit(2.0)) + FLOORS[i]).alias(f"s{i}") for i in range(P)]
    middle = written(middle.join(spread, keys).select(*keys, *[f"o{i}" for i in range(P)], *scale), "quality-scales")
    scaled = dealt.join(middle, keys).select(*keys, *[((F.col(x) - F.col(f"o{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i, x in enumerate(X)])
    z = [F.col(f"z{i}") for i in range(P)]
    scaled = scaled.withColumn("length", F.greatest(F.sqrt(reduce(lambda a, b: a + b, [v * v for v in z])), F.lit(1e-9)))
    signs, tangents = ([f(v).alias(f"y{i}") for i, v in enumerate(z)] for f in (lambda v: v / F.col("length") * math.sqrt(P), F.tanh))
    shapes = scaled.select(*keys, F.inline(F.array(*[F.struct(F.lit(k).alias("g_start"), *y) for k, y in ((1, signs), (2, tangents))])))
    shapes = sums(shapes, [*keys, "g_start"], [F.col(f"y{i}") for i in range(P)])
    first = middle.select(*keys, F.lit(0).alias("g_start"), *[F.lit(0.0).alias(m) for m in M], *[F.lit(float(i == j)).alias(f"c{i}{j}") for i, j in L])
    both = shapes.unionByName(first).join(middle, keys)
    # Back from scaled rows: about the median, products times both scales.
    back = both.select(*keys, "g_start", *[F.col(f"o{i}").alias(m) for i, m in enumerate(M)], *[((F.col(f"c{i}{j}") - F.col(M[i]) * F.col(M[j])) * F.col(f"s{i}") * F.col(f"s{j}") + F.col(f"o{i}") * F.col(f"o{j}")).alias(f"c{i}{j}") for i, j in L])
    return with_factor(back, 1.0, [*keys, "g_start"])


def concentrated(dealt: DataFrame, params: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Estimates from the SHARE of rows nearest to ``params``, for every group and start."""
    own = [*keys, "g_start"]
    far = dealt.join(params, keys).select(*own, *X, distance([F.col(x) for x in X]).alias("d"))
    edge = written(far.groupBy(*own).agg(F.percentile_approx("d", SHARE, 1000).alias("edge")), f"quality-edge-{name}")
    inner = far.join(edge, own).where("d <= edge")
    return written(with_factor(sums(inner, own, [F.col(x) for x in X]), consistency(SHARE, P), own), f"quality-params-{name}")


def estimates(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """The estimate of least determinant of every group (columns X and ``keys``)."""
    params = written(starts(dealt, keys), "quality-starts")
    for step in range(EARLY):
        params = concentrated(dealt, params, keys, str(step))
    value = F.struct("log_det", "g_start", *M, *L.values())
    best = params.groupBy(*keys).agg(F.min(value).alias("v")).select(*keys, "v.*")
    for step in range(EARLY, MOST):
        best = written(best, f"quality-best-{step}")
        then = concentrated(dealt, best, keys, str(step)).select(*keys, F.struct("log_det", "g_start", *M, *L.values()).alias("now"))
        both = best.select(*keys, value.alias("was")).join(then, keys)
        if both.where(F.col("now.log_det") < F.col("was.log_det") - SETTLED).isEmpty():
            break
        best = both.select(*keys, F.least("was", "now").alias("v")).select(*keys, "v.*")
    return best


def outlier(x: list[Column]) -> Column:
    """Far from the bulk, and on the side of junk: more symbols, repeats or shouting than the centre has, or words of odd length."""
    worse = reduce(lambda a, b: a | b, [x[i] > F.col(M[i]) + 3 * math.sqrt(FLOORS[i]) for i in range(2, P)]) | (F.abs(x[1] - F.col(M[1])) > 3 * math.sqrt(FLOORS[1]))
    return F.coalesce((distance(x) > CUTOFF) & worse, F.lit(False))


def _keyed(docs: DataFrame, lang_col: str, source_col: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id``, the base counts, ``base_failed, distance`` (null without an estimate) and ``kept`` of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *_keyed(docs, lang_col, source_col), F.col(text_col).alias("text"))
    stats = written(counts(rows, F.col("text"), "counts").drop("text"), "quality-counts")
    c = F.col("counts")
    judged = stats.join(fit(stats), ["lang", "source"], "left")
    x = vector(c)
    return judged.select("doc_id", *[c[k].alias(k) for k in BASE_COUNTS], base_failed(c).alias("base_failed"), distance(x).alias("distance"), (~base_failed(c) & ~outlier(x)).alias("kept"))


def drop_poor(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that are kept, all columns as they are.

    The rows are written once with their counts: the estimates read the counts alone, the verdicts stand beside the
    texts. Joining verdicts to texts instead would shuffle the texts and need a key that is never null or repeated.
    """
    lang, source = _keyed(docs, lang_col, source_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), lang, source, F.col(text_col).alias("body"))
    rows = written(counts(rows, F.col("body"), "counts").drop("body"), "quality-rows")
    params = written(fit(rows.select("lang", "source", "counts")), "quality-estimates")
    c = F.col("counts")
    judged = rows.join(params, ["lang", "source"], "left")
    return judged.where(~base_failed(c) & ~outlier(vector(c))).select("row.*")
