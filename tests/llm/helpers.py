"""Small tables with null, empty, repeated and clashing parts for the operator tests."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, source="s"):
    """A documents table from {doc_id: text} or (doc_id, text) pairs."""
    pairs = texts.items() if isinstance(texts, dict) else texts
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in pairs]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def with_clashes(df):
    """``df`` with extra columns named like the ones operators and stages use inside or add."""
    from pyspark.sql import functions as F
    names = """id key h a b n m c t row doc copy copies root score predicted spans host path rule place shard mix_n mix_copy mix_key
mix words band bands __key __id __row rate cdf salt source_rates w r d s hash own token total bytes label held_out p term terms
counts kinds whole groups item value rank phrase block blocks seq lang_too first first_id links size two with text_hash""".split()
    return df.select("*", *[F.lit("clash").alias(n) for n in names if n not in df.columns])
