"""Filter interaction audit by contractions of contingency tensors.

Every document becomes one cell of a table with an axis of two places (pass, fail) for each
filter.  Spark counts the cells of each part (documents, good ones, toxic ones), so what is left
of a part is a tensor of 2**filters counts, whatever its size.  What a filter does at a step of an
order is a contraction of that tensor: each axis is selected by (1, 0) for passing, (0, 1) for
failing or (1, 1) for either, and all orders and steps are contracted at once by ``einsum``.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm.common import materialize, release, table
from forgeline.session import scratch_tables

SPACE = r"[\x20\x09-\x0D]+"
FEWEST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 2
SIGNS = "[#$%&*|]"
FILTERS = "ABCDE"        # E, repeated text, is the one that needs other documents
NULL_ID_SALTS = 1024     # rows without an id are spread over so many join keys

MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)
PASS, FAIL, EITHER = (1, 0), (0, 1), (1, 1)


def selectors(filters: str = FILTERS) -> tuple[list[tuple[str, int]], np.ndarray, dict[str, np.ndarray]]:
    """(order, step) of every row, its filter's axis, and for each measure the selecting pairs, shape (rows, axes, 2)."""
    rows, axes = [], []
    chosen: dict[str, list] = {"kept": [], "removed": [], "failing": [], "alone": []}
    for order in permutations(filters):
        for step, letter in enumerate(order):
            before = set(order[:step])
            rows.append(("".join(order), step + 1))
            axes.append(filters.index(letter))
            chosen["kept"].append([PASS if f in before or f == letter else EITHER for f in filters])
            chosen["removed"].append([FAIL if f == letter else PASS if f in before else EITHER for f in filters])
            chosen["failing"].append([FAIL if f == letter else EITHER for f in filters])
            chosen["alone"].append([FAIL if f == letter else PASS for f in filters])
    return rows, np.array(axes), {k: np.array(v, np.int64) for k, v in chosen.items()}


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Counts (weight, row) of a tensor (weight, 2, ..., 2) under the selecting pairs (row, axis, 2)."""
    axes = [f"r{c}" for c in "abcdefgh"[:chosen.shape[1]]]
    return np.einsum(f"w{''.join(a[1] for a in axes)},{','.join(axes)}->wr", tensor, *np.moveaxis(chosen, 1, 0), optimize="greedy")


def measures(tensor: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """The measures of each (order, step) row from a part's tensor (documents / good / toxic, 2, ..., 2)."""
    rows, axis, chosen = selectors(filters)
    removed = contract(tensor, chosen["removed"])
    documents = tensor[:1]
    lost = np.zeros(len(filters), np.int64)
    np.add.at(lost, axis, removed[0])
    return {"kept": contract(documents, chosen["kept"])[0], "removed": removed[0],
            "redundant": contract(documents, chosen["failing"])[0] - removed[0],
            "unique_fails": contract(documents, chosen["alone"])[0],
            "good_lost": removed[1], "toxic_lost": removed[2],
            "shapley": lost[axis]}


def _audit_part(filters: str):
    order_steps = selectors(filters)[0]

    def audit(cells: pa.Table) -> pa.Table:
        tensor = np.zeros((3, 2 ** len(filters)), np.int64)
        for w, c in enumerate(("documents", "good", "toxic")):
            np.add.at(tensor[w], cells["cell"].to_numpy(), cells[c].to_numpy())
        # bit i of a cell's number is filter i's verdict: the last axis of the reshaped tensor is filter 0
        tensor = tensor.reshape((3,) + (2,) * len(filters)).transpose(0, *range(len(filters), 0, -1))
        out = measures(tensor, filters)
        return pa.table({"part": [cells["part"][0].as_py()] * len(order_steps),
                         "filter_order": [o for o, _ in order_steps], "step": pa.array([s for _, s in order_steps], pa.int32()),
                         **{m: pa.array(out[m], pa.int64()) for m in MEASURES}})
    return audit


def interactions(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """All orders and steps of every part, from its counts.

    ``cells``: part, cell (bit i set: filter i fails), documents, good, toxic; one row per part and
    cell, at most 2**len(filters) rows a part.  A cell that is missing counts as zero.
    """
    return cells.groupBy("part").applyInArrow(_audit_part(filters), RESULT)


def text_verdicts(text: Column) -> list[Column]:
    """Whether filters A to D fail a text (not null)."""
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words).cast("long")
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return [n < FEWEST_WORDS, 100 * F.size(F.array_distinct(words)).cast("long") < LEAST_DISTINCT_PERCENT * n,
            100 * capitals.cast("long") > MOST_CAPITAL_PERCENT * F.char_length(text).cast("long"), text.rlike(SIGNS)]


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of each part's cells: part, cell, documents, good, toxic.

    Texts are one text if their SHA-256 is.  Copies are counted by (text, part, labels) before anything
    is joined by text, so a text that a third of all rows repeat is a few rows to any task.
    """
    text = F.coalesce("text", F.lit(""))
    verdicts = text_verdicts(F.col("__text"))
    bits = sum((v.cast("int") * (1 << i) for i, v in enumerate(verdicts)), F.lit(0))
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(NULL_ID_SALTS))).otherwise(F.lit(0).cast("long"))
    rows = (docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("__text"), salt.alias("salt"))
            .select("doc_id", "salt", "part", F.unhex(F.sha2("__text", 256)).alias("key"), bits.alias("bits")))
    flags = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
             .withColumn("salt", F.lit(0).cast("long")))
    rows = rows.join(flags, ["doc_id", "salt"], "left").select(
        "doc_id", "salt", "part", "key", "bits", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    alike = ["key", "part", "bits", "good", "toxic"]
    ids = rows.groupBy("doc_id", "salt", *alike).agg(F.count("*").alias("n"))
    known = F.col("doc_id").isNotNull()
    groups = materialize(ids.groupBy(*alike).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("unknown"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first")), "audit-groups")
    # the smallest id of each text that occurs more than once; it and rows without an id repeat nothing smaller
    least = groups.groupBy("key").agg(F.sum("n").alias("rows"), F.min("first.doc_id").alias("least")).where("rows > 1").select("key", "least")
    passes = F.when(F.col("least").isNull() | F.col("first").isNull(), F.col("n")).otherwise(
        F.col("unknown") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0))
    split = (groups.join(least, "key", "left").select("part", "bits", "good", "toxic", "n", passes.alias("passes"))
             .select("part", "good", "toxic", F.explode(F.array(
                 F.struct(F.col("bits").alias("cell"), F.col("passes").alias("n")),
                 F.struct((F.col("bits") + (1 << FILTERS.index("E"))).alias("cell"), (F.col("n") - F.col("passes")).alias("n")))).alias("c")))
    return split.groupBy("part", "c.cell").agg(
        F.sum("c.n").alias("documents"), F.sum(F.col("good") * F.col("c.n")).alias("good"), F.sum(F.col("toxic") * F.col("c.n")).alias("toxic"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Audit of five text filters in all 120 orders: one row per part (source), order and step.

    A null text counts as empty, a null source as the empty string; rows that are repeated count
    each for itself.  Rows that share an id and a text repeat nothing smaller, nor does a row whose
    id is null, which no label names and which is no smaller id for others.  A document is good
    (toxic) if any of its label rows says 1.  Extra columns are not read, very long texts are
    judged whole, and an empty table has no parts and gives no rows.
    """
    with scratch_tables([]) as used:
        counted = cells(docs, labels)
    counted = materialize(counted, "audit-cells")
    release(*used)
    return interactions(counted)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter interactions of all ``documents`` with their ``labels``."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH RECURSIVE
words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
marked AS (SELECT d.part, coalesce(s.good, 0) AS good, coalesce(s.toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
    CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM words d LEFT JOIN said s ON d.doc_id = s.doc_id),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
grown AS (SELECT '' AS o UNION ALL SELECT o || l FROM grown, letters WHERE NOT contains(o, l)),
steps AS (SELECT o, s.step, substr(o, s.step, 1) AS f, substr(o, 1, s.step - 1) AS before
  FROM grown, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s WHERE length(o) = 5),
seen AS (SELECT c.*, o, step, f, contains(fails, f) AS failing,
    len(list_filter(string_split(before, ''), lambda x: x <> '' AND contains(fails, x))) > 0 AS gone FROM cells c, steps),
counted AS (SELECT part, o, step, f, coalesce(sum(n) FILTER (WHERE NOT failing AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE failing AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (WHERE failing AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE fails = f), 0) AS unique_fails, coalesce(sum(good) FILTER (WHERE failing AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE failing AND NOT gone), 0) AS toxic_lost FROM seen GROUP BY part, o, step, f)
SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
