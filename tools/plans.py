"""Write PLANS.md: physical plans of key queries with what to look for.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aidspark.operators import catalog as CT  # noqa: E402
from aidspark.operators import joins as J  # noqa: E402
from aidspark.operators import lattice as LT  # noqa: E402
from aidspark.operators import marts as M  # noqa: E402
from aidspark.operators.clean import clean_aid, clean_measure  # noqa: E402
from aidspark.operators.dedup import dedup_keep_last  # noqa: E402
from aidspark.operators.analysis import q_instrument_share, q_top_grantors  # noqa: E402
from aidspark.operators.flatten import flatten_aid  # noqa: E402
from aidspark.schemas import AID_DEDUP_KEY  # noqa: E402
from aidspark.session import get_session, scratch_dir  # noqa: E402
from aidspark.plans import bucketed as BK  # noqa: E402
from aidspark.plans import storage as ST  # noqa: E402
from aidspark.plans.yeartable import YearTable  # noqa: E402
from aidspark.sources import standin as S  # noqa: E402
from aidspark.sources import xml as X  # noqa: E402

NOTES = {
    "mart_per_obiettivo": "Filters pushed to the scan, 5 columns read; partial aggregate on (group, fiscal "
                          "code) before the first exchange (the distinct is a two-phase aggregate, no Expand); "
                          "the share window runs after the final aggregate on year-partitioned aggregated rows.",
    "mart_territorio": "Two aggregates over one scan each, the type shares pivoted with max(when) before a "
                       "1:1 join on (year, region); benchmark windows on the joined aggregated rows.",
    "mart_top_beneficiari": "orderBy+limit planned as TakeOrderedAndProject: each task keeps 1000 rows.",
    "dedup_keep_last": "max_by over a struct buffer is planned as a sort-based aggregate: each input "
                       "partition is sorted by key (spillable) and reduced by partial_max_by before the "
                       "exchange, so a hot key is one row per input partition in the shuffle.",
    "join_aid_measure": "Both sides aggregated to one row per car before the join; no broadcast hint "
                        "(AQE decides from runtime sizes).",
    "q_instrument_share": "One scan; the grand total is a window over the aggregated rows (one per "
                          "instrument type).",
    "q_top_grantors": "Year filter on the partition column prunes the scan to one folder.",
    "mart_base": "One scan of the raw layer feeds the sets of all marts: Expand, partial aggregate map-side, one exchange.",
    "mart_from_base": "The territory mart from the counted rows: the scan prunes to its set's folder.",
    "year_of_lots": "A year of two lots: both are scanned, keep-last by key (map-side partial) merges them; a year of one "
                    "lot is a plain scan.",
    "bucketed_keep_last": "Grouping a bucketed table by its key: no exchange.",
    "footer_counts": "Rows per year from file footers: PushedAggregation, no data page is read.",
    "xml_flatten": "Text scan -> record cut -> repair -> from_xml -> two posexplode_outer -> projection: "
                   "no exchange anywhere (narrow), and from_xml appears once.",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[4]", shuffle_partitions=8)
    raw_path = scratch_dir(spark, "plans-raw")
    ST.write_year_overwrite(S.aid_raw(spark, sf_dir), raw_path)
    raw = spark.read.parquet(raw_path)
    clean = clean_aid(raw)
    base_path = scratch_dir(spark, "plans-base")
    LT.base(clean).write.partitionBy(LT.SET).parquet(base_path)
    base = spark.read.parquet(base_path)
    table = YearTable(spark, scratch_dir(spark, "plans-lots"))
    year = max(map(int, table.overwrite(raw)["years"]))
    table.upsert(raw.where(raw["anno"] == year).limit(10))
    bucketed = BK.write_bucketed(raw, "plans_bucketed", scratch_dir(spark, "plans-buckets"), AID_DEDUP_KEY, 8)
    xml_dir = None
    try:
        from aidspark.sources import xml_standin as XS
        xml_dir = XS.write_aid_xml(spark, sf_dir, scratch_dir(spark, "plans-xml"))
    except Exception:  # noqa: BLE001
        pass
    frames = {
        "mart_base": LT.base(clean),
        "mart_from_base": LT.mart(M.mart_territorio, base),
        "year_of_lots": table.read([year]),
        "bucketed_keep_last": BK.keep_last(bucketed, AID_DEDUP_KEY, "titolo_misura"),
        "footer_counts": CT.footer_plan(spark, raw_path),
        "mart_per_obiettivo": M.mart_per_obiettivo(clean),
        "mart_territorio": M.mart_territorio(clean),
        "mart_top_beneficiari": M.mart_top_beneficiari(clean),
        "dedup_keep_last": dedup_keep_last(S.aid_raw(spark, sf_dir, with_arrival=True), AID_DEDUP_KEY, "_arrival"),
        "join_aid_measure": J.join_aid_measure(clean, clean_measure(S.measure_raw(spark, sf_dir))),
        "q_instrument_share": q_instrument_share(raw),
        "q_top_grantors": q_top_grantors(raw, 1998),
    }
    if xml_dir:
        frames["xml_flatten"] = flatten_aid(X.read_aid_xml(spark, xml_dir))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    out = ["# Physical plans of key queries", "",
           f"Generated by `tools/plans.py` on `{sf_dir}` (initial adaptive plans).", ""]
    for name, df in frames.items():
        text = df._jdf.queryExecution().explainString(mode)
        text = text.replace(raw_path, "<raw layer>").replace(xml_dir or "\0", "<xml dump>")
        out += [f"## {name}", "", NOTES[name], "", "```", text.strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
