import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from ledgerline.llm import exact_dedup
from ledgerline.llm.common import scratch_tables, staged


def there(path):
    return os.path.exists(path.removeprefix("file:"))


def test_scratch_tables_go_with_their_block(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id BIGINT, text STRING")
    kept = staged(spark, docs, "own")
    with scratch_tables(spark) as outer:
        rows = staged(spark, docs, "outer")
        with scratch_tables(spark) as inner:
            exact_dedup.keep(docs).write.parquet(str(tmp_path / "out"))
            assert inner and all(map(there, inner)) and not set(inner) & set(outer)
        assert not any(map(there, inner)) and len(outer) == 1 and rows.count() == 3
    assert not there(outer[0]) and kept.count() == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_scratch_tables_go_after_an_error(spark):
    with pytest.raises(ValueError), scratch_tables(spark) as held:
        staged(spark, spark.range(3).toDF("x"), "broken")
        assert there(held[0])
        raise ValueError
    assert not there(held[0])
