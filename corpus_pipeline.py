"""The corpus pipeline: five stages, each result stored as Parquet and read again as the next stage's documents.

1. quality rules: documents that the rules reject go;
2. SimHash near-duplicates: of each group the document with the smallest id stays, one row of it if it is repeated;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scan: secrets in the text are replaced, and ``n_chars`` follows where there is such a column;
5. packing: the remaining documents as pieces in length buckets and batches.

Stages 1 to 4 return the columns of ``documents`` as they came, whatever other columns there are. Rows are told apart by a hash
of all their columns and not by ``doc_id``, so rows without an id, or with the same id, are judged each by its own text.
An empty table passes through all stages. Neither the texts nor copies of them are shuffled or stored between the stages'
results, as long as the list of rows that a stage changes is short enough to be broadcast; a longer one is joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontamination, packing, quality_rules, secrets, simhash
from clickloom.llm.common import staged
from clickloom.sources.tables import read_table


#: Longest list of rows that is sent to every executor.
BROADCAST_ROWS = 300_000


def numbered(docs: DataFrame) -> DataFrame:
    """``_uid``, a hash of 128 bits of the row, and ``row``, the whole row.

    It comes from the row's content alone, so it is the same however files are split and whatever executors there are. Equal rows
    have the same one, and the same verdict.
    """
    # Maps cannot be hashed; NULLs leave a hash as it is, so where they are is hashed too.
    columns = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    content = [*[c.isNull() for c in columns], *columns]
    uid = F.concat_ws("-", F.hex(F.xxhash64(*content)), F.hex(F.xxhash64(F.lit("second"), *content)))
    return docs.select(uid.alias("_uid"), F.struct("*").alias("row"))


def joined(rows: DataFrame, listed: DataFrame, how: str) -> DataFrame:
    """``rows`` with what is listed for their ``_uid``. The list is stored and counted: a short one is broadcast."""
    listed = staged(listed, "listed-rows")
    return rows.join(F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed, "_uid", how)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    judged = quality_rules.judge(rows, "_uid", "row.text")
    return joined(rows, judged.where("not kept").select(F.col("doc_id").alias("_uid")), "left_anti").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    named = rows.select(F.struct("row.doc_id", "_uid").alias("id"), F.col("row.text").alias("text"))
    groups = simhash.near_duplicates(named, "id", "text", words=4, max_bits=4)
    go = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id._uid")
    left = joined(rows, go, "left_anti")
    again = staged(rows.groupBy("_uid").count().where("count > 1").select("_uid", F.lit(True).alias("again")), "repeated-rows")
    if again.isEmpty():
        return left.select("row.*")
    left = joined(left, again, "left")
    return left.where("again is null").unionByName(left.where("again").dropDuplicates(["_uid"])).select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    held = decontamination.matches(rows, read_table(spark, sf_dir, "benchmark"), "_uid", "row.text")
    return joined(rows, held.select(F.col("doc_id").alias("_uid")).distinct(), "left_anti").select("row.*")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    path = "row.source" if "source" in docs.columns else None
    found = secrets.scan(rows, "_uid", "row.text", path).where("n_secrets > 0").select(F.col("doc_id").alias("_uid"), "positions").dropDuplicates(["_uid"])
    known = joined(rows, found, "left")
    text = secrets.redacted(F.col("row.text"), F.col("positions"))
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("positions").isNotNull(), F.length(text).cast(kind)).otherwise(F.col("row.n_chars")))
    return known.select(row.alias("row")).select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]
#: SQL cannot express the estimates inside the stages; tests compare the result with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
