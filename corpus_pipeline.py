"""The corpus pipeline: quality, language, near-duplicates, benchmark leaks, packing.

Each stage takes all that the one before kept and returns the columns of ``documents``; the last
one returns packed pieces. Between stages the rows are written as Parquet and read again. Inside a stage
the columns have numbers for names, so no extra column can clash with one that an operator adds. Texts of
any length are taken whole, ties are broken as each stage says, and an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import decontam, ecoc_langid, gbt_quality, packing, simhash_jaccard, tokens
from pitpanel.llm.common import table, written

#: A text is rejected by language if no language is found or the best one's score is below this.
LEAST_LANGUAGE_SCORE = 0.5


def numbered_columns(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns _c0, _c1, ..., and each old name's new one."""
    names = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(n).alias(c) for c, n in names.items()))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the boosted trees predict to be of low quality.

    Null, empty and blank texts have statistics of zero and are judged by them; equal texts are judged
    alike, whatever their ids. Without labels all stay.
    """
    forest = gbt_quality.train(docs, table(spark, sf_dir, "labels"))
    rows, names = numbered_columns(docs)
    scored = gbt_quality.score(rows, forest, keep=rows.columns, id_col=names["doc_id"], text_col=names["text"])
    return restored(scored.where("predicted = 1"), names)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language (null, empty or without a letter) and those whose language stays unclear.

    Equal texts are judged alike. Where no row has both a text and a language, nothing can be learned and all go.
    """
    model = ecoc_langid.train(docs)
    rows, names = numbered_columns(docs)
    judged = ecoc_langid.predict(rows, model, keep=rows.columns, id_col=names["doc_id"], text_col=names["text"])
    return restored(judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE)), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest doc_id, of each group linked by 0.8 of five-word shingles.

    Documents are told apart by doc_id and text, so texts that share an id are judged one by one; a null id comes
    last in its group. Of repeated rows one stays. Texts without words (null, empty, blank) are one group.
    """
    rows, names = numbered_columns(docs)
    found, groups = simhash_jaccard.grouped(rows, id_col=names["doc_id"], text_col=names["text"])
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id"), "text_hash"))
    kept = found.join(groups, "cid").groupBy("group").agg(first.alias("k")).select(F.col("k.none").alias("_none"), F.col("k.id").alias("_id"), F.col("k.text_hash").alias("_hash"))
    key = ["_none", "_id", "_hash"]
    keyed = rows.withColumns({"_none": F.col(names["doc_id"]).isNull(), "_id": F.coalesce(names["doc_id"], F.lit(0)), "_hash": F.xxhash64(names["text"])})
    return restored(keyed.join(kept, key, "left_semi").dropDuplicates(key), names)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an exact or edited copy of a benchmark item.

    A document is judged by its text alone, so nulls, repeats and clashes of ids don't matter; equal texts
    stay or go together. Null and empty texts stay.
    """
    rows, names = numbered_columns(docs)
    rows = rows.withColumn("_key", F.xxhash64(names["text"]))
    leaks = decontam.contaminated(rows.select("_key", names["text"]), table(spark, sf_dir, "benchmark"), id_col="_key", text_col=names["text"])
    return restored(rows.join(leaks.select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_anti"), names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens from all that is left; the workers serve other stages too, so they keep nothing.

    A null or empty text is its end id alone; repeated rows and ids get places of their own.
    """
    return packing.pack(packing.pieces(docs, tokens.default_path(), remembered=100_000, keep=False))


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("pack", pack)]

#: Trained models, components and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
