"""Quality rules of documents, judged together with their host's record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.rows import fresh, row_key, without
from stockflow.llm.words import BLANK
from stockflow.storage import stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINES = 3
# A host is rejected when its shrunk rate of documents with a failure is above this.
MAX_HOST_RATE = 0.5
# Bounds of the weight of the prior, in documents.
PRIOR_WEIGHT = (1.0, 10_000.0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once for all its uses."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more.

    Only texts whose windows repeat are sorted; equal windows are then neighbours.
    """

    def covered(windows: Column) -> Column:
        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def neighbours(order: Column) -> Column:
            pairs = F.zip_with(
                F.slice(order, F.lit(1), F.size(order) - 1),
                F.slice(order, F.lit(2), F.size(order) - 1),
                lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(
                    F.array().cast("array<int>")
                ),
            )
            places = F.transform(
                F.array_distinct(F.flatten(pairs)), lambda i: F.array(i, i + 1, i + 2)
            )
            return F.size(F.array_distinct(F.flatten(places)))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(F.sort_array(placed), neighbours)
        )

    def windows(all_words: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(all_words) - 3),
            lambda i: F.xxhash64(all_words[i], all_words[i + 1], all_words[i + 2]),
        )

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(windows(words), covered))


def measures(text: Column) -> Column:
    """A struct of the base measures of a text; null counts as no text."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(f"[^{BLANK[1:]}"))

    def measured(words: Column) -> Column:
        long = lambda value, name: value.cast("bigint").alias(name)
        return F.struct(
            long(F.size(words), "n_words"),
            long(F.length(F.regexp_replace(whole, BLANK, "")), "word_chars"),
            long(F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")), "n_symbols"),
            long(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), "n_dup_lines"),
            long(_repeated(words), "n_repeat_words"),
        )

    return let(F.array_remove(F.split(whole, f"{BLANK}+"), ""), measured)


def base_failed() -> Column:
    """The rules every document must meet by itself."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def failed() -> Column:
    """A failure on a host's record: a base rule, many symbols or repeated lines."""
    return (
        base_failed()
        | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
        | (F.col("n_dup_lines") > MAX_DUP_LINES)
    )


def prior(hosts: DataFrame) -> tuple[float, float]:
    """The beta prior of failure rates, by the method of moments over hosts (host, n, bad).

    Its mean is the overall rate; its weight is what leaves the spread of the rates
    beyond that of chance. Two sums over one row per host; one row reaches the driver.
    """
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("k")).first()
    if not total["n"]:
        return 1.0, 1.0
    mean = total["bad"] / total["n"]
    if total["k"] < 2 or not 0 < mean < 1:
        return PRIOR_WEIGHT[0] * max(mean, 1e-6), PRIOR_WEIGHT[0] * max(1 - mean, 1e-6)
    moments = hosts.agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - mean, 2)).alias("spread"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    chance = mean * (1 - mean)
    free = total["n"] - moments["squares"] / total["n"]
    between = max(0.0, (moments["spread"] - (total["k"] - 1) * chance) / max(free, 1.0))
    weight = chance / between - 1 if between else PRIOR_WEIGHT[1]
    weight = min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
    return weight * mean, weight * (1 - mean)


def judged(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           host_column: str = "source") -> DataFrame:
    """(id, host, measures…, base_failed, host_rate, kept) for every document.

    Failures are summed by host, the host's rate is shrunk towards a beta prior fitted
    over all hosts, and the host's verdict is joined back: a document is kept if it
    meets the base rules and its host's rate is at most ``MAX_HOST_RATE``. A hot host is
    no hot task: sums combine on the map side, and the join carries a few numbers per
    document, which Spark can split. Null hosts are one host; null texts have no words
    and fail; repeated rows are judged and counted each; ties do not arise. Columns
    besides the three named are not read. An empty table gives no rows.
    """
    rows = documents.select(
        F.col(id_column).alias("id"),
        F.col(host_column).alias("host"),
        measures(F.col(text_column)).alias("m"),
    )
    rows = stored(rows.select("id", "host", "m.*"), "measures")
    hosts = rows.groupBy("host").agg(
        F.count("*").alias("n"), F.sum(failed().cast("bigint")).alias("bad")
    )
    bad, good = prior(hosts)
    rates = hosts.select(
        F.col("host").alias("of_host"),
        ((F.col("bad") + bad) / (F.col("n") + bad + good)).alias("host_rate"),
    )
    found = rows.join(rates, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host")
    return found.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("host_rate") <= MAX_HOST_RATE)
    )


def keep_good(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              host_column: str = "source") -> DataFrame:
    """The documents that are kept, columns unchanged.

    Rejected rows leave by an anti join on a digest of id, text and host, on which the
    verdict depends, so rows that share an id are judged each. Rows with a null id are
    judged by the base rules alone.
    """
    columns = [id_column, text_column, host_column]
    name = fresh(documents, "row_key")
    keyed = documents.withColumn(name, row_key(*columns))
    lost = judged(keyed, name, text_column, host_column).where(~F.col("kept"))
    named = F.col(id_column).isNotNull()
    kept = without(documents.where(named), columns, lost.select("id"))
    alone = measures(F.col(text_column))
    good = (alone["n_words"] >= MIN_WORDS) & (
        100 * alone["n_repeat_words"] <= MAX_REPEAT_PERCENT * alone["n_words"]
    )
    return kept.union(documents.where(~named).where(good))
