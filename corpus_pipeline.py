"""The corpus pipeline: five of the training-data operators, one after the other, over ``documents``.

Each stage takes what its predecessor kept (as Parquet, read again) and returns
the columns of ``documents``; the last one adds the token ids.

* language: documents whose language can't be told go (``und``, or a score
  below ``MIN_LANGUAGE_SCORE``).  The model learns from the labelled documents.
* quality: documents that fail the base rule or the learned decision list go.
* dedup: of each group of linked fingerprints the smallest id stays.
* mix: every document stays and gets its place in the mixture to ``TARGET_WEIGHTS``
  (Spark may read the files of a stage in any order), in a column after the others
  that its metadata tells, as the documents may have any column names.
* encode: adds ``token_ids``, ``n_tokens`` and ``mix_position``, the place that the
  mix stage gave (null without one), and writes in its order.

The result of ``run`` has its rows in the order of the mixture, without ``mix_position``.

Null texts have no language and go in the first stage.  Repeated rows of one id
leave one in the dedup stage.  Columns of ``documents`` named like those of the last stage are replaced there; all others
pass, whatever their names.  Empty documents give an empty result.  No stage can be expressed in SQL as a whole (three
of them learn), so ``ORACLE_SQL`` is None; tests hold it against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagic.llm import bpe_automaton, catalog, decision_list, langid, pfair_mix, simhash_gph
from pelagic.llm.common import fresh, own_columns, shared_folder, table

MIN_LANGUAGE_SCORE = 0.5
# Share of each source in the mixture; sources not listed share a thousandth.
TARGET_WEIGHTS = {"src0": 0.24, **{f"src{k}": 0.04 for k in range(1, 20)}}
PLACE = {"pelagic": "mix_position"}  # metadata of the column that the mix stage adds
ENCODED = ("token_ids", "n_tokens", "mix_position")  # columns of the last stage
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs)
    (language,) = fresh(docs, "__language")
    found = langid.predict_language(docs, model, into=language)
    known = (F.col(language)["lang_pred"] != langid.UNDETERMINED) & (F.col(language)["score"] >= MIN_LANGUAGE_SCORE)
    return found.filter(known).select(*own_columns(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = decision_list.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    (quality,) = fresh(docs, "__quality")
    return decision_list.judge(docs, rules, into=quality).filter(F.col(quality)["kept"]).select(*own_columns(docs))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_gph.keep_one(docs).select(*own_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with their places in the mixture, range-partitioned and sorted by it."""
    mix, position = fresh(docs, "__mix", "mix_position")
    place = F.col(mix)["position"].alias(position, metadata=PLACE)
    mixed = pfair_mix.pfair_mix(docs, TARGET_WEIGHTS, into=mix).select(*own_columns(docs), place)
    return mixed.repartitionByRange(position).sortWithinPartitions(position)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    places = [f.name for f in docs.schema.fields if f.metadata == PLACE]
    own = [c for c in docs.columns if c not in places and c.lower() not in ENCODED]
    place = F.col(f"`{places[0]}`") if places else F.lit(None).cast("long")
    docs = docs.select(*[F.col(f"`{c}`") for c in own], place.alias("mix_position", metadata={}))
    if places:
        docs = docs.repartitionByRange("mix_position").sortWithinPartitions("mix_position")
    out = bpe_automaton.bpe_encode(docs, catalog.vocabulary())
    return out.select(*[F.col(f"`{c}`") for c in own], "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), "mix_position")


STAGES = [("language", language), ("quality", quality), ("dedup", dedup), ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, in the order of the mixture; each result is written to the shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4()}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs.orderBy("mix_position").drop("mix_position")
