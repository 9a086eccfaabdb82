"""The pipeline's stages, one after the other, against plain versions."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tidemill.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_stages(spark, sf_dir, documents_here):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact", "near", "substring", "packing"]
    kept = [(i, t) for i, t in documents_here if t and any(c.isalpha() for c in t)]
    by = {}
    for i, t in sorted(kept):
        by.setdefault(brute.normal(t), (i, t))
    kept = list(by.values())
    groups = brute.near_groups(kept, 80)
    kept = [(i, t) for i, t in kept if groups[i][1] == i]
    cleaned = []
    for (i, t), (words, gone) in zip(kept, brute.kept_words([t for _, t in kept]), strict=True):
        cleaned.append((i, " ".join(w for w, g in zip(words, gone, strict=True) if not g) if any(gone) else t))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = [(i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in cleaned]
    brute.packed_right(corpus_pipeline.run(spark, sf_dir).collect(), ids)


def test_stages_on_odd_rows(spark, odd, nothing):
    for start in (odd, nothing):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == start.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
        assert max(Counter((r.sequence_id, r.offset) for r in rows).values(), default=1) == 1


def test_texts_stay_without_any_language(spark, odd, odd_rows):
    kept = corpus_pipeline.known_language(spark, odd.withColumn("lang", F.lit(None).cast("string")), "").collect()
    wanted = [(i, t) for i, t in odd_rows if t and any(c.isalpha() for c in t)]
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(wanted, key=repr) and wanted


def test_queries_against_their_sql(spark, sf_dir):
    """Every query of this part that has SQL, by names, types and values."""
    import duckdb

    from tidemill.llm import registry

    connection = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    assert set(registry.ORACLE_SQL) == {"op3_neardup", "op6_substring", "op8_exact", "op11_search"}
    for name, sql in registry.ORACLE_SQL.items():
        cursor, frame = connection.execute(sql), registry.QUERIES[name](spark, sf_dir)
        kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean"}
        assert dict(frame.dtypes) == {d[0]: kinds[str(d[1])] for d in cursor.description}
        columns = [d[0] for d in cursor.description]
        assert sorted(tuple(r[c] for c in columns) for r in frame.collect()) == sorted(cursor.fetchall())
