"""Language models: trigrams, fitting, accuracy outside the sample, corpora without labels."""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from compare import DATA
from sedimenta.functions.language import LanguageModel, detect, gram_text, trigrams
from sedimenta.operators import language


def grams_of(text):
    t = re.sub(r"[\W\d_]+", " ", f" {text.lower()} ")
    return Counter(t[k : k + 3] for k in range(len(t) - 2))


@pytest.mark.parametrize("texts", [["Über 12 Straßen!", "", "a", "日本語 und 😀 x"], ["..."], [], ["\ud800 lone"]])
def test_trigrams(texts):
    row, keys = trigrams(texts)
    got = [Counter() for _ in texts]
    for r, k in zip(row, keys):
        got[r][gram_text(int(k))] += 1
    assert got == [grams_of(t) for t in texts]


def test_fit_against_plain_counts(spark):
    rows = [(1, "der Hund und die Katze", "de"), (2, "the dog and the cat", "en"), (3, "the cat", "en"), (4, None, "en"), (5, "no label", None), (None, "no key", "en")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), vocabulary=20)
    counts = {"de": grams_of(rows[0][1]), "en": grams_of(rows[1][1]) + grams_of(rows[2][1])}
    total = counts["de"] + counts["en"]
    own = sorted(total, key=lambda g: (-total[g], g))[:20]
    assert model.languages == ["de", "en"] and [gram_text(int(k)) for k in model.keys] == sorted(own)
    for g, line in zip(sorted(own), model.weights):
        for k, c in enumerate(counts.values()):
            assert math.isclose(line[k], math.log((c[g] + 1) / (sum(c[x] for x in own) + 20)))
    assert model.of(pd.Series(["die Katze und der Hund", "short", None, "1234567890 1234567890", "", "the dog and the cat" * 900])) == ["de", "und", "und", "und", "und", "en"]


def test_accuracy_outside_the_sample(spark):
    """Over 0.95 in each language of the table, from at most 60 texts of each."""
    docs = spark.read.parquet(str(DATA / "sf0.1" / "documents.parquet"))
    model = language.fit(docs, 60)
    assert language.sampled(docs, 60).count() < 60 * 4 * 1.5
    rest = docs.join(language.sampled(docs, 60).select("doc_id"), "doc_id", "left_anti").where(F.length(F.trim("text")) >= 20)
    told = rest.select("lang", detect("text", model).alias("code")).groupBy("lang").agg(F.avg((F.col("lang") == F.col("code")).cast("int")).alias("right")).collect()
    assert {r.lang for r in told} == {r.lang for r in docs.select("lang").distinct().collect()}
    assert all(r.right > 0.95 for r in told), told


def test_corpus_without_labels(spark):
    docs = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet")).select("doc_id", "text", "lang")
    model = language.bootstrap(docs.drop("lang"))
    assert model.languages == sorted(language.SEEDS)
    rows = docs.where(F.length("text") > 200).select("lang", detect("text", model).alias("code")).collect()
    assert np.mean([r.lang == r.code for r in rows]) > 0.9
    nothing = language.bootstrap(docs.limit(0))
    assert nothing.of(pd.Series(["the cat is in the house and it was on the roof", "la casa de los perros en el campo y las flores"])) == ["en", "es"]


def test_model_is_kept(spark, tmp_path):
    model = LanguageModel(["a", "b"], np.array([5, 9]), np.array([[-1.0, -2.0], [-3.5, -0.5]]))
    language.save(model, spark, f"{tmp_path}/m")
    again = language.load(spark, f"{tmp_path}/m")
    assert again.languages == model.languages and again.keys.tolist() == [5, 9] and np.array_equal(again.weights, model.weights)
    with pytest.raises(FileNotFoundError):
        language.load(spark, f"{tmp_path}/none")
    assert LanguageModel([], np.empty(0, np.int64), np.empty((0, 0))).of(pd.Series(["a text of twenty characters and more"])) == ["und"]
