"""Every registered query of the engine against its SQL counterpart on the driver's smallest tables."""

import pytest

from compare import DATA, differences
from sedimenta.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert name in ORACLES
    assert differences(spark, QUERIES[name], ORACLES[name], str(DATA / "sf0.001")) == ""


def test_a_census_of_odd_texts(spark, tmp_path):
    """Blank and null texts, and line ends that JSON leaves as they are, in each of the four shapes."""
    words = "some words " * 20
    texts = ["", " \n\u3000", None, "12 %", "short", words, f"{words}\u2028{words}", f"a\x85{words}", f"{words}\r\n\u2029 x", f"\x1c{words}\x0b."]
    rows = [(4 * k + shape, t, "s", "en") for k, t in enumerate(texts) for shape in range(4)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert differences(spark, QUERIES["census_paths"], ORACLES["census_paths"], str(tmp_path)) == ""


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["doc_id", "fuente", "formato", "fenomeno", "texto_limpio"]
    assert df.count() == 200
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
