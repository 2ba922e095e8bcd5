"""The corpus pipeline: toxicity, line dedup, near duplicates, source mix, BPE.

Each stage takes what its predecessor kept. All but the last return the columns
of documents; the last returns each kept copy with its token ids.

Defined results at every stage: null and empty texts pass as they are until the
mix, which has no words to take from them and leaves them out; rows that repeat
a doc_id are separate documents; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.bpe import encode_decode
from fleetscope.llm.common import emptied, held, scratch_tables, ship_package, table
from fleetscope.llm.jaccard import jaccard_components
from fleetscope.llm.linededup import dedup_lines
from fleetscope.llm.mixing import mix
from fleetscope.llm.queries import tokenizer_path
from fleetscope.llm.toxicity import fit, score

TOKENIZER = "byte_bpe_50k.json"


#: Rows of one file, at most; and files whose names go to every task.
FILE_ROWS, MOST_FILES = 1 << 40, 100_000


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, doc): the rows of ``docs`` as structs, whatever their columns are called, each with a key of its own that
    stays the same when read again.

    Rows of Parquet files have one: their file and their place in it. Other rows are stored with a number."""
    spark, packed = docs.sparkSession, F.struct("*").alias("doc")
    try:
        placed = docs.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), packed)
    except AnalysisException:
        return held(docs.select(F.monotonically_increasing_id().alias("row"), packed), "pipeline-rows")
    files = sorted(r["file"] for r in placed.select("file").distinct().collect())  # Spark's driver lists them to read them
    if len(files) > MOST_FILES:
        return held(docs.select(F.monotonically_increasing_id().alias("row"), packed), "pipeline-rows")
    numbers = spark.createDataFrame(list(enumerate(files)), "number long, file string")
    return placed.join(F.broadcast(numbers), "file").select((F.col("number") * FILE_ROWS + F.col("at")).alias("row"), "doc")


#: Rows whose numbers of copies are packed in one block; and blocks that go to every task.
BLOCK_ROWS, MOST_BLOCKS = 32, 1 << 22


def _copied(keyed: DataFrame, copies: DataFrame) -> DataFrame:
    """(doc, n): the rows that ``copies`` names, once each with its n, 1 to 3.

    Two bits a row go to every task, so documents are not shuffled; only if these were too many, a join moves them."""
    block, shift = F.expr(f"row div {BLOCK_ROWS}"), (F.col("row") % BLOCK_ROWS * 2).cast("int")
    mine = F.call_function("shiftleft", F.col("n").cast("long"), shift)
    blocks = held(copies.groupBy(block.alias("block")).agg(F.bit_or(mine).alias("ns")), "pipeline-blocks")
    if blocks.count() > MOST_BLOCKS:
        return keyed.join(copies, "row").select("doc", "n")
    n = F.call_function("shiftrightunsigned", F.col("ns"), shift).bitwiseAND(F.lit(3)).cast("int")
    return keyed.withColumn("block", block).join(F.broadcast(blocks), "block").select("doc", n.alias("n")).filter("n > 0")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5."""
    ship_package(spark)
    model = fit(docs, table(spark, sf_dir, "labels"))
    packed = docs.select(F.struct("*").alias("doc")).select("doc", F.col("doc.text").alias("text"))
    return score(packed, model).filter("score < 0.5").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line of the corpus matches. A document all of whose lines
    with words are gone is a copy of others and goes; n_chars is counted anew."""
    out = dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.coalesce(F.col("doc.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    counted = F.when(F.col("n_removed") > 0, F.col("doc").withField("n_chars", F.length("doc.text").cast("long"))).otherwise(F.col("doc"))
    return out.filter(left).select(counted.alias("doc")).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their five-word shingles: the one with the smallest doc_id
    (then the first row). Documents without words link with nothing and stay."""
    ship_package(spark)
    keyed = _keyed(docs)
    rows = keyed.select("row", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    groups = jaccard_components(rows.select("row", "text"), shingle=5, percent=80, doc_id="row").select(F.col("doc_id").alias("row"), "component_id")
    named = groups.join(rows.select("row", "doc_id"), "row")
    best = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row")).alias("m")).select("m.row")
    return _copied(keyed, best.withColumn("n", F.lit(1))).select("doc.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes its words, rounded: 0 to 3 rows."""
    ship_package(spark)
    keyed = _keyed(docs)
    takes = mix(keyed.select("row", F.col("doc.text").alias("text"), F.col("doc.source").alias("source")), doc_id="row").filter("size > 0")
    copies = takes.select(F.col("doc_id").alias("row"), F.least(F.lit(3), F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int").alias("n")).filter("n > 0")
    return _copied(keyed, copies).select("doc", F.explode(F.sequence(F.lit(1), F.col("n")))).select("doc.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens, ids_sha256, decoded_sha256 of every row."""
    ship_package(spark)
    return encode_decode(docs, tokenizer_path(TOKENIZER), outputs=("ids", "n_tokens", "ids_sha256", "decoded_sha256"), keep=("doc_id", "source"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("source_mix", source_mix), ("bpe", bpe)]

#: The score, the mix and the token ids are not expressible in SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), []
    for k, (name, stage) in enumerate(STAGES):
        with scratch_tables() as made:
            docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            with scratch_tables() as kept:
                docs = held(docs, f"pipeline-{name}")
            emptied(spark, [*read, *made])  # nothing reads them any more
            read = kept
    return docs
