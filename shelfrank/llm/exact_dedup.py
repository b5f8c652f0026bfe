"""Exact deduplication by a streaming job with keyed state on disk.

The digests of all texts run as a stream into a keyed aggregate whose state lives in RocksDB and
never expires: per digest it holds the stable identifier and the content locator (file and row)
of the document that stays, and the number of copies. Afterwards the state is read as a table. A
digest met more than once is a hit: the full bytes of each such text are compared with
those of the document that stays, and texts that only share the digest form groups of their own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm.common import listed, one_space, table, written
from shelfrank.llm.registry import query
from shelfrank.session import new_folder

# Copies compared with one copy of the kept text; larger groups are salted.
GROUP_ROWS = 256
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Many small state partitions must not reserve disk space ahead.
_NO_RESERVE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _located(docs: DataFrame) -> DataFrame:
    """Every document as one struct ``doc``, with the file and row it comes from; tables not in files, and such as have a
    column ``_metadata`` of their own, are written first."""
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    doc = F.struct("*").alias("doc")
    if "_metadata" not in [c.lower() for c in docs.columns]:
        try:
            return docs.select(doc, *place)
        except AnalysisException:
            pass
    return written(docs.select(doc), "located").select("doc", *place)


def keep_state(digests: DataFrame, folder: str) -> DataFrame:
    """Run the stored digests (``digest, keep``) through the stateful job; give its state.

    A later run with the same ``folder`` goes on from the kept state. Result: ``digest``, the smallest
    ``keep`` struct and ``copies``.
    """
    spark = digests.sparkSession
    before = {key: spark.conf.get(key, None) for key in (_PROVIDER, _NO_RESERVE)}
    spark.conf.set(_PROVIDER, _ROCKSDB)
    spark.conf.set(_NO_RESERVE, "false")
    try:
        source = digests.inputFiles()[0].rpartition("/")[0] if digests.inputFiles() else None
        if source is None:
            return digests.groupBy("digest").agg(F.min("keep").alias("keep"), F.count(F.lit(1)).alias("copies"))
        stream = spark.readStream.schema(digests.schema).parquet(source)
        kept = stream.groupBy("digest").agg(F.min("keep").alias("keep"), F.count(F.lit(1)).alias("copies"))
        job = (
            kept.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", folder).trigger(availableNow=True).start()
        )
        job.awaitTermination()
        state = spark.read.format("statestore").load(folder)
        value = state.schema["value"].dataType.names
        return written(
            state.select(
                F.col("key")[state.schema["key"].dataType.names[0]].alias("digest"),
                F.col("value")[value[0]].alias("keep"),
                F.col("value")[value[1]].alias("copies"),
            ),
            "kept",
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 256
) -> DataFrame:
    """Mark every row of ``docs`` with the group of equal texts it belongs to.

    Texts are equal when identical after each run of ASCII white space became one space; null counts
    as empty. One row per document: its id, ``keep_id`` (id of the row that stays: the smallest; null ids last;
    of repeated ids the first row by file and row number), ``group_size``, ``kept`` and ``digest`` (binary).
    An empty table gives an empty result; other columns, whatever their names, do not matter. ``digest_bits`` cuts the digest short
    (tests use it to make digests collide).
    """
    return _marked(_located(docs), id_col, text_col, digest_bits).drop("__file", "__row")


def _marked(located: DataFrame, id_col: str, text_col: str, digest_bits: int = 256) -> DataFrame:
    """As ``exact_dedup``, with the file and row of every document."""
    spark = located.sparkSession
    number, norm = F.col("doc").getField(id_col), one_space(F.col("doc").getField(text_col))
    digest = F.unhex(F.sha2(norm, 256))
    if digest_bits < 256:
        digest = F.substring(digest, 1, digest_bits // 8)
    keep = F.struct(
        number.isNull().alias("no_id"), number.alias("id"), F.col("__file").alias("file"),
        F.col("__row").alias("row"),
    )
    digests = written(located.select(digest.alias("digest"), keep.alias("keep")), "digests")
    state = keep_state(digests, new_folder(spark, "dedup-state"))

    # Full bytes of the hits, against the text that stays.
    hits = state.where("copies > 1").select("digest", F.col("keep").alias("first"), "copies")
    texts = located.select(digest.alias("digest"), norm.alias("norm"), keep.alias("keep"))
    # Only texts of hits move, where the list of hit digests is short enough to be sent out.
    texts = texts.join(listed(hits.select("digest")), "digest", "left_semi").join(hits, "digest")
    salts = F.ceil(F.col("copies") / GROUP_ROWS).cast("int")
    stays = F.col("keep") == F.col("first")
    salted = texts.select(
        "digest", "norm", "keep", stays.alias("stays"),
        F.explode(
            F.when(stays, F.sequence(F.lit(0), salts - 1)).otherwise(
                F.array(F.pmod(F.xxhash64("keep"), salts).cast("int"))
            )
        ).alias("salt"),
    ).repartition("digest", "salt")
    group = Window.partitionBy("digest", "salt").orderBy(F.col("stays").desc())
    compared = salted.withColumn("same", F.first("norm").over(group) == F.col("norm"))
    odd = written(compared.where(~F.col("same")).select("digest", "norm", "keep"), "odd")

    odd_groups = odd.groupBy("digest", "norm").agg(F.min("keep").alias("odd_keep"), F.count(F.lit(1)).alias("odd_size"))
    odd_rows = odd.join(odd_groups, ["digest", "norm"]).select(
        F.col("keep.file").alias("__file"), F.col("keep.row").alias("__row"), "odd_keep", "odd_size"
    )
    fewer = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("fewer"))
    groups = state.join(fewer, "digest", "left").select(
        "digest", F.col("keep").alias("first"), (F.col("copies") - F.coalesce("fewer", F.lit(0))).alias("size")
    )
    placed = digests.select("digest", F.col("keep.file").alias("__file"), F.col("keep.row").alias("__row"), "keep")
    marked = (
        placed.join(groups, "digest")
        .join(odd_rows, ["__file", "__row"], "left")
        .select(
            "__file", "__row", "digest", "keep",
            F.coalesce("odd_keep", "first").alias("winner"),
            F.coalesce("odd_size", "size").alias("group_size"),
        )
    )
    return marked.select(
        "__file", "__row", F.col("keep.id").alias(id_col), F.col("winner.id").alias("keep_id"), "group_size",
        (F.col("keep") == F.col("winner")).alias("kept"), "digest",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text a row with a smaller id has already; same columns."""
    located = _located(docs)
    stay = _marked(located, id_col, text_col).where("kept").select("__file", "__row")
    return located.join(stay, ["__file", "__row"], "left_semi").select("doc.*")


_SQL = r"""
WITH normal AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
groups AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM normal JOIN groups USING (norm)
"""


@query("op8_exact_dedup", _SQL)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = exact_dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return marked.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
