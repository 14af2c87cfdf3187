"""Language models fitted to a corpus: counts of trigrams from a bounded sample, by Spark."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.language import LanguageModel, heads, trigrams
from ..plans.durable import read_version, write_version

#: Texts of each language that a model is fitted to, about, chosen by a hash of their keys; trigrams that it keeps.
SAMPLE, VOCABULARY = 2000, 4000
#: Frequent words of each language (public stop-word lists, shortened). They only start a model for a corpus without labels.
SEEDS = {
    "de": "der die und das den von mit ist nicht des auf für im dem ein eine als auch sich zu aus",
    "en": "the of and to in is that for it was with as on be by this are from or an at",
    "es": "el la de que y en los del las un por con una para su se al es lo como más",
    "fr": "le la les des et est dans que pour qui sur une du au pas par avec il sont ce ne",
    "it": "il di che la e per un in non una sono con del si da come le dei nel alla gli",
    "pt": "o de que e do da em um para com não uma os no se na por mais as dos ao",
}
_HASHES = 1 << 32


def drawn(key: Column) -> Column:
    """A number of 32 bits, even over keys."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")


def sampled(labelled: DataFrame, sample: int = SAMPLE, key: str = "doc_id") -> DataFrame:
    """About `sample` rows of each language, all if there are fewer. labelled: key, text, lang."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col(key).isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    return rows.join(F.broadcast(sizes), "lang").where(drawn(F.col(key)) * F.col("_n") < F.lit(sample) * F.lit(_HASHES)).drop("_n")


def _counted(batches):
    for rows in batches:
        row, keys = trigrams(heads(rows["text"]))
        if len(keys):
            found = pd.DataFrame({"lang": rows["lang"].to_numpy()[row], "gram": keys}).value_counts().reset_index(name="n")
            yield found[["lang", "gram", "n"]]


def fit(labelled: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY, key: str = "doc_id") -> LanguageModel:
    """The model of (key, text, lang): the most frequent trigrams of the sample, with add-one smoothing in each language.

    Ties in frequency: first by code points. What comes to the driver is bounded: `vocabulary` rows for each language.
    """
    texts = sampled(labelled.select(key, "text", "lang"), sample, key).select("lang", "text")
    counts = texts.mapInPandas(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()
    top = counts.groupBy("gram").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "gram").limit(vocabulary).select("gram")
    rows = counts.join(F.broadcast(top), "gram").collect()
    counts.unpersist()
    languages, keys = sorted({r["lang"] for r in rows}), np.array(sorted({r["gram"] for r in rows}), np.int64)
    table = np.zeros((len(keys), len(languages)))
    table[np.searchsorted(keys, [r["gram"] for r in rows]), [languages.index(r["lang"]) for r in rows]] = [r["n"] for r in rows]
    return LanguageModel(languages, keys, np.log((table + 1) / (table.sum(axis=0) + len(keys))))


def _seeds_in(words: Column, own: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(own)))


def bootstrap(texts: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE, clear: float = 0.2) -> LanguageModel:
    """A model for a corpus without labels: texts in which the frequent words of one language are `clear` of all words, and
    more than twice those of any other, stand for it; so do these words themselves."""
    words = F.split(F.lower(F.substring(text, 1, 2000)), r"[^\p{L}]+")
    counted = [_seeds_in(words, v.split()).alias(k) for k, v in SEEDS.items()]
    rows = texts.select(F.col(key).cast("string").alias("doc_id"), F.col(text).alias("text"), F.size(words).alias("_n"), *counted)
    ranked = F.sort_array(F.array(*[F.struct(F.col(k).alias("n"), F.lit(k).alias("lang")) for k in SEEDS]), asc=False)
    rows = rows.withColumn("r", ranked).where((F.col("r")[0]["n"] >= clear * F.col("_n")) & (F.col("r")[0]["n"] > 2 * F.col("r")[1]["n"]))
    own = texts.sparkSession.createDataFrame([(f"\n{k}", v, k) for k, v in SEEDS.items()], "doc_id string, text string, lang string")
    return fit(rows.select("doc_id", "text", F.col("r")[0]["lang"].alias("lang")).unionByName(own), sample)


def save(model: LanguageModel, spark, path: str) -> None:
    """The model as a table in versions: (gram, lang, weight)."""
    rows = [(int(g), lang, float(w)) for g, line in zip(model.keys, model.weights, strict=True) for lang, w in zip(model.languages, line, strict=True)]
    write_version(spark.createDataFrame(rows, "gram long, lang string, weight double").coalesce(1), path)


def load(spark, path: str) -> LanguageModel:
    found = read_version(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    rows = found.collect()
    languages, keys = sorted({r["lang"] for r in rows}), np.array(sorted({r["gram"] for r in rows}), np.int64)
    weights = np.zeros((len(keys), len(languages)))
    weights[np.searchsorted(keys, [r["gram"] for r in rows]), [languages.index(r["lang"]) for r in rows]] = [r["weight"] for r in rows]
    return LanguageModel(languages, keys, weights)
