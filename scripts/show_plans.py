"""Print the physical plans of the main operators (markdown) — used to write PLANS.md.

Usage: python scripts/show_plans.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tablexport.functions.columns import convert_datetimes  # noqa: E402
from tablexport.operators.balance import assign_balanced, balanced_chunk_table, balanced_groups  # noqa: E402
from tablexport.operators.union_batches import union_batches  # noqa: E402
from tablexport.plans.chunks import plan_table  # noqa: E402
from tablexport.plans.split_spec import SplitSpec  # noqa: E402
from tablexport.session import RECOMMENDED_CONF  # noqa: E402


def plan_text(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue().strip()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "16"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    o = spark.read.parquet(f"{sf}/orders.parquet")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    part = spark.read.parquet(f"{sf}/part.parquet")

    def plan(df_, text, eo):
        return plan_table(df_, [SplitSpec.parse(text)], exactly_once=eo)

    cases = []
    p = plan(o, "orders,between,o_orderkey,number,5000,0,14999", False)
    cases.append(("number `between` chunk counts (as written): range filter pushed to Parquet, partial aggregation",
                  p.summary(o)))
    p = plan(o, "orders,like,o_custkey,number,1,1,12", True)
    cases.append(("number `like`, exactly once: one broadcast hash join per prefix length, same stage as the scan",
                  p.assign(o).select("o_orderkey", "chunk_no")))
    p = plan(o, "orders,range,o_orderdate,date,12", True)
    cases.append(("yearly `range` + ISO text: arithmetic chunk column, pruned scan",
                  convert_datetimes(p.assign(o).select("o_orderkey", "o_orderdate", "chunk_no"), "oracle", "__dt_str")))
    p = plan(o, 'orders,query,"o_orderstatus;o_orderpriority"', True)
    cases.append(("distinct combinations: null-safe broadcast join with the (checkpointed) combination table",
                  p.assign(o).select("o_orderkey", "chunk_no")))
    p = plan(part, 'part,query,"p_brand",like,p_brand', False)
    cases.append(("values as prefixes of another column (as written): joins per value length, explode of matches",
                  p.assign(part).select("p_partkey", "chunk_no")))
    cases.append(("balanced groups: weights of coarse buckets (partial aggregation), windows over them and "
                  "inside the buckets in which a group ends, group aggregation", balanced_groups(li, "l_orderkey", 256)))
    groups = balanced_groups(li, "l_orderkey", 256)
    chunks = balanced_chunk_table(groups)
    cases.append(("balanced assignment: log-depth CASE on the key inside the scan stage (no join)",
                  assign_balanced(li, "l_orderkey", chunks, residual=len(chunks) + 1).groupBy("chunk_no").count()))
    p = plan(o, "orders,between,o_orderkey,number,9,0,14999", False)
    cases.append(("UNION batches: one shuffle hashed on the whole row",
                  union_batches(p.assign(o), ["o_orderstatus", "o_orderpriority"], "chunk_no", 100)))
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    p = plan(pages, 'pages,query,"url",like,url', False)  # 29 distinct url lengths
    cases.append(("values as prefixes with many distinct lengths (as written): candidates exploded, one equi-join",
                  p.assign(pages).select("page_id", "chunk_no")))
    lr = li.repartition(8)
    p = plan(lr, "lineitem,range,l_shipdate,date,12", True)
    cases.append(("export input from a multi-partition scan: REBALANCE by chunk before the Avro writer "
                  "(AQE splits a skewed chunk)", p.assign(lr).hint("rebalance", "chunk_no")))
    print("# Physical plans of the main operators\n")
    print(f"Generated by `python scripts/show_plans.py {sf}` (local[8], AQE on). `isFinalPlan=false`: plans as "
          "submitted; AQE may still coalesce partitions or turn a join into a broadcast at run time.\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{plan_text(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
