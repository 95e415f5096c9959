"""The language stage rejects texts of scripts that the model has not learned."""

import random

from pyspark.sql import functions as F

from forktide.llm import language_id
from forktide.llm.language_id import language_stage


def test_stage_drops_unlearned_scripts_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = ["привет как дела сегодня", "нет", "我们今天去学校学习中文", "γειά σου κόσμε", "12 34"]
    more = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in language_stage(spark, docs.unionByName(more.select(docs.columns)), sf_dir).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in docs.where("text RLIKE '[\\\\p{L}]'").select("doc_id").collect()}


def test_every_label_is_learned_however_many(spark):
    """150 languages of equal size, none of which has a hundredth of the rows."""
    rnd = random.Random(3)
    words = [["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 8))) for _ in range(60)] for _ in range(150)]
    rows = [(12 * k + i, " ".join(rnd.choices(words[k], k=40)), f"l{k:03d}") for k in range(150) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.train(language_id.training_sample(docs))
    assert len(model.languages) == 150 and [w.shape[1] for w in model.weights] == [64, 64, 22]
    found = language_id.identify(docs, model, ["doc_id", "lang"]).where(language_id.fold(F.col("doc_id")) == 0).collect()
    assert len(found) > 200 and sum(r["lang"] == r["lang_pred"] for r in found) > 0.95 * len(found)
    assert language_id.language_stage(spark, docs, "").count() > 0.98 * len(rows)
