"""The salvage fold works each part out once (F5): a record's text is cut into tokens
once, and what a lambda names twice is bound."""

from pyspark.sql import functions as F

from aidspark.functions.salvage import salvage_xml
from aidspark.schemas import AID_RECORD_TAG, AID_XML_SCHEMA


def test_tokens_and_edits_are_worked_out_once(spark):
    texts = [("<AIUTO><COR>1<CUP>x</CUP></AIUTO>",), ("<AIUTO><COR id= >2</COR></CUP> a < b</AIUTO><COR>3</COR>",), ("<AIUTO/>",)]
    out = spark.createDataFrame(texts, "t string").select(salvage_xml(F.col("t"), AID_RECORD_TAG, AID_XML_SCHEMA).alias("s"))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("map_from_entries(") == 1
    assert [r["s"] for r in out.collect()] == ["<AIUTO><COR>1</COR><CUP>x</CUP></AIUTO>", "<AIUTO><COR>2</COR> a &lt; b</AIUTO>", "<AIUTO/>"]
