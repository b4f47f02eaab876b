import pyarrow.parquet as pq

from duewise.llm import token_alignment as ta


def test_blocks_are_written_a_few_at_a_time(spark):
    docs = spark.createDataFrame([(k, f"text number {k} of some") for k in range(60)], "doc_id long, text string").coalesce(1)
    conf, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(conf, 3)  # a block ends with a batch, at this size of blocks
    try:
        blocks = ta.aligned_blocks(docs, block_bytes=1)
        assert blocks.count() == 20
        for file in blocks.inputFiles():
            found = pq.ParquetFile(file.removeprefix("file://")).metadata
            assert max(found.row_group(k).num_rows for k in range(found.num_row_groups)) <= ta.GROUP_BLOCKS
        assert sorted(r["doc_id"] for r in ta.align_tokenizers(docs, block_bytes=1).collect()) == list(range(60))
    finally:
        spark.conf.set(conf, before)
