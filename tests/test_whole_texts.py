"""Damage is looked for in whole texts."""

from strandloom.functions.text import repair_text
from strandloom.plans.library import QUERIES


def test_damage_late_in_a_text_is_repaired(spark, tmp_path):
    late = "plain words " * 60 + "caf\u00e9 na\u00efve"
    docs = [(1, late), (2, "plain " * 90)]
    at = f"file://{tmp_path}"
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    got = {r.doc_id: (r.repaired, r.encoding) for r in QUERIES["mojibake"](spark, at).collect()}
    wanted = {i: repair_text(t.encode().decode("latin-1")) for i, t in docs}
    assert wanted[1][0] and got == {i: w for i, w in wanted.items() if w[1]}
