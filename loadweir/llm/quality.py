"""Quality rules whose thresholds come from the corpus: quantile sketches per language and source.

A sketch is a histogram over buckets whose width is at most 1/32 of their lower edge, so quantiles
are good to that share and sketches merge by adding counts. A language's sketch is the sum of its
sources', and the corpus' the sum of all. A source with too few documents is judged by its language,
and a language with too few by the corpus. Everything here is Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadweir.llm.common import BLANKS

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Documents that a sketch needs to set thresholds of its own.
LEAST_DOCUMENTS = 100
#: Fences lie this many times the distance of the quartiles beyond them.
REACH = 3
#: Each metric, and what its upper and its lower fence (None: none) keep from the quartile at least.
#: Symbols, repeated lines and repeated words are per thousand; word lengths are in tenths.
RULES = {"symbols": (50, None), "dup_lines": (100, None), "repeats": (100, None), "length": (10, 10)}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _count_without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of :data:`BASE`, ``n_lines`` and ``base_failed``.

    Words are separated by ASCII blanks. ``n_dup_lines`` are lines with a word that equal an earlier
    one; ``n_repeat_words`` are the words in three-word windows that the text holds twice or more.
    Null and empty texts have zero of each and fail. Columns of these names are replaced.

    Windows are found by one sort of each text's window hashes with their places; those whose hash
    meets another are compared word by word.
    """
    names = {*BASE, "n_lines", "base_failed"}
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.btrim(body, F.lit(BLANKS))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = docs.select(
        F.struct(*kept).alias("row"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANKS}]+")).alias("w"),
        _count_without(body, BLANKS).cast("long").alias("word_chars"),
        (F.char_length(body) - _count_without(body, SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    out = out.select(
        "row",
        "w",
        F.size("w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("length(bin(size(w)))").alias("b"),
    )
    window = "shiftleft(shiftright(xxhash64(w[i], w[i + 1], w[i + 2]), b), b) | i"
    # the hash's high bits, then the place in the text
    hashed = f"if(size(w) < 3, array(), sort_array(transform(sequence(0, size(w) - 3), i -> {window})))"
    out = out.withColumn("s", F.expr(hashed).cast("array<bigint>"))
    met = (
        "filter(s, (x, k) -> (k > 0 and shiftright(s[greatest(k - 1, 0)], b) = shiftright(x, b))"
        " or (k < size(s) - 1 and shiftright(s[least(k + 1, size(s) - 1)], b) = shiftright(x, b)))"
    )
    out = out.withColumn("c", F.expr(f"transform({met}, x -> int(x & (shiftleft(1L, b) - 1)))")).drop("s", "b")
    exact = "sort_array(transform(c, i -> named_struct('t', concat_ws(' ', w[i], w[i + 1], w[i + 2]), 'i', i)))"
    out = out.withColumn("g", F.expr(exact)).drop("c", "w")
    twice = (
        "filter(g, (x, k) -> (k > 0 and g[greatest(k - 1, 0)].t = x.t)"
        " or (k < size(g) - 1 and g[least(k + 1, size(g) - 1)].t = x.t))"
    )
    covered = (
        f"aggregate(sort_array(transform({twice}, x -> x.i)), named_struct('n', 0L, 'e', 0),"
        " (a, x) -> named_struct('n', a.n + x + 3 - greatest(x, a.e), 'e', x + 3), a -> a.n)"
    )
    out = out.withColumn("n_repeat_words", F.expr(covered))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("row.*", *BASE, "n_lines", failed.alias("base_failed"))


def _metrics() -> dict[str, Column]:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols": F.floor(1000 * F.col("n_symbols") / words),
        "dup_lines": F.floor(1000 * F.col("n_dup_lines") / lines),
        "repeats": F.floor(1000 * F.col("n_repeat_words") / words),
        "length": F.floor(10 * F.col("word_chars") / words),
    }


def sketches(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Histograms of the metrics of documents that pass the base rules, by ``keys``: metric, bucket, n."""
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), value.alias("v")) for name, value in _metrics().items()])
    rows = measured.where(~F.col("base_failed")).select(*[f"`{k}`" for k in keys], F.explode(pairs).alias("m"))
    spare = F.greatest(F.length(F.bin("m.v")) - 6, F.lit(0))
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col("m.v"), spare), spare)
    return rows.groupBy(*keys, "m.metric", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches added up to coarser ``keys``."""
    return sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """For each of ``keys``: ``documents``, and ``<metric>_low`` and ``<metric>_high`` from the quartiles."""
    group = [*keys, "metric"]
    gathered = sketch.groupBy(*group).agg(
        F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("h")
    )  # buckets are few: at most 32 for each doubling of the metric
    running = (
        "aggregate(h, named_struct('c', 0L, 'lo', cast(null as bigint), 'hi', cast(null as bigint)), (a, x) ->"
        " named_struct('c', a.c + x.n, 'lo', if(a.lo is null and 4 * (a.c + x.n) >= total, x.bucket, a.lo),"
        " 'hi', if(a.hi is null and 4 * (a.c + x.n) >= 3 * total, x.bucket, a.hi)))"
    )
    quartiles = gathered.select(*group, "total", F.expr(running).alias("q"))
    spread = REACH * (F.col("q.hi") - F.col("q.lo"))
    # a bucket's values reach up to 1/32 beyond its lower edge
    top = F.col("q.hi") + F.floor(F.col("q.hi") / 32)
    bounds = []
    for name, (above, below) in RULES.items():
        mine = F.col("metric") == name
        high = top + F.greatest(spread, F.lit(above))
        low = F.lit(0)
        if below is not None:
            low = F.col("q.lo") - F.greatest(spread, F.lit(below))
        bounds += [F.max(F.when(mine, high)).alias(f"{name}_high"), F.max(F.when(mine, low)).alias(f"{name}_low")]
    return quartiles.groupBy(*keys).agg(F.max("total").alias("documents"), *bounds)


def judge(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` (a staged :func:`measure`) with ``kept`` and ``broken``, the metrics out of bounds.

    A document is kept if it passes the base rules and every metric lies within the fences of its
    language and source. A null language or source is a group of its own. Without any document that
    passes the base rules nothing is kept. Columns of these names are replaced.
    """
    bounds = [f"{name}_{end}" for name in RULES for end in ("low", "high")]
    fine = sketches(measured, [lang, source])
    by_source, by_lang = fences(fine, [lang, source]), fences(merged(fine, [lang]), [lang])
    overall = fences(merged(fine, []), []).first()
    a, b, d = by_source.alias("a"), by_lang.alias("b"), measured.alias("d")
    joined = d.join(a, F.col(f"d.`{lang}`").eqNullSafe(F.col(f"a.`{lang}`")) & F.col(f"d.`{source}`").eqNullSafe(F.col(f"a.`{source}`")), "left")
    joined = joined.join(b, F.col(f"d.`{lang}`").eqNullSafe(F.col(f"b.`{lang}`")), "left")
    limit = {
        x: F.when(F.col("a.documents") >= LEAST_DOCUMENTS, F.col(f"a.{x}"))
        .when(F.col("b.documents") >= LEAST_DOCUMENTS, F.col(f"b.{x}"))
        .otherwise(F.lit(overall[x] if overall and overall["documents"] else None).cast("long"))
        for x in bounds
    }
    broken = [
        F.when(~value.between(limit[f"{name}_low"], limit[f"{name}_high"]), F.lit(name))
        for name, value in _metrics().items()
    ]
    broken = F.array_compact(F.array(*broken))
    kept = ~F.col("d.base_failed") & (F.size(broken) == 0)
    own = [F.col(f"d.`{c}`") for c in measured.columns if c not in ("kept", "broken")]
    return joined.select(*own, kept.alias("kept"), broken.alias("broken"))
