"""Operators leave the session's settings as they are, and their lazy results may run in any order."""

import public_tokenizers

from cardrisk.llm import bpe, secret_scan, suffix_dedup, warc_zstd
from cardrisk.llm.common import table
from cardrisk.llm.queries import QUERIES, vocabulary_path
from conftest import SF_SMALL

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_settings_stay_and_results_do_not_depend_on_the_order(spark):
    before = {r.key: r.value for r in spark.sql("SET").collect()}
    spark.conf.set(ROWS, "777")
    try:
        docs = table(spark, SF_SMALL, "documents")
        make = {
            "warc": lambda: warc_zstd.archive_round_trip(spark, table(spark, SF_SMALL, "pages")),
            "secrets": lambda: secret_scan.scan_secrets(spark, docs, vocabulary_path(), public_tokenizers.PATTERN),
            "ids": lambda: bpe.tokenize_digests(spark, docs, vocabulary_path(), public_tokenizers.PATTERN),
            "repeats": lambda: suffix_dedup.remove_repeats(spark, docs),
        }
        lazy = {k: f() for k, f in make.items()}
        assert spark.conf.get(ROWS) == "777"
        forth = {k: sorted(map(repr, df.collect())) for k, df in lazy.items()}
        back = {k: sorted(map(repr, make[k]().collect())) for k in reversed(make)}
        assert forth == back and spark.conf.get(ROWS) == "777"
        QUERIES["op1_line_crf_quality"](spark, SF_SMALL)
        QUERIES["op3_lsh_forest_dedup"](spark, SF_SMALL)
        assert spark.conf.get(ROWS) == "777"
    finally:
        spark.conf.set(ROWS, before.get(ROWS, "10000"))
    after = {r.key: r.value for r in spark.sql("SET").collect() if r.key != ROWS}
    assert after == {k: v for k, v in before.items() if k != ROWS}
