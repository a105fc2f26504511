"""Packed archives take every document and its whole text."""

from strandloom.plans.library import QUERIES
from strandloom.sources import archives


def test_long_documents_have_identities_and_whole_texts(spark, tmp_path):
    text = 'a "quoted", part\r\nand\nlines ' * 9000
    docs = [(1, text, "en", "s", len(text)), (2, "short", "en", "s", None), (3, None, "en", "s", None)]
    at = f"file://{tmp_path}"
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    assert {r.path for r in QUERIES["identity_extract"](spark, at).collect()} == {"/1.lpd", "/2.lpd", "/3.lpd"}
    packed = {r.path: archives.data_members(bytes(r.content))["text.csv"] for r in archives.packed(spark.read.parquet(f"{at}/documents.parquet")).collect()}
    assert ["".join(c for row in packed[f"/{k}.lpd"] for c in row) for k in (1, 2, 3)] == [text, "short", ""]
