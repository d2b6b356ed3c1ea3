"""Time the headline steps and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each step starts from stored inputs and ends with a result that is fully computed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from cladeweave.operators import hierarchy, links
from cladeweave.plans.full_run import Staged, merge_all
from cladeweave.plans.merge import merge_taxonomy
from cladeweave.runtime import BINARY, materialize, release
from cladeweave.sources import checklist, staging
from workload import fixtures as fx

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, build):
        start = time.perf_counter()
        result = build()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    # inputs, not timed
    taxa_in = materialize(fx.staged_taxa(spark, SF_DIR), "in-taxa")
    synonyms = materialize(fx.staged_synonyms(spark, SF_DIR), "in-synonyms")
    redlist = materialize(fx.staged_redlist(spark, SF_DIR), "in-redlist")
    common = materialize(staging.stage_common_names(fx.staged_common_names(spark, SF_DIR)), "in-names")
    tables = {name: materialize(df, f"in-{name}") for name, df in fx.checklist(spark, SF_DIR).items()}

    taxa = timed("number_taxa", lambda: materialize(staging.number_taxa(taxa_in, collation=BINARY), "taxa"))
    timed("closure", lambda: drain(hierarchy.closure(taxa)))
    line = timed("lineage", lambda: hierarchy.lineage(taxa, collation=BINARY))
    merged = timed("merge", lambda: materialize(merge_taxonomy(taxa, line, BINARY), "merged"))
    noted = timed("prepare_synonyms", lambda: materialize(links.prepare_synonyms(synonyms, line), "noted"))
    timed("relink_synonyms", lambda: drain(links.relink_synonyms(noted, merged, BINARY)))
    red = timed("prepare_redlist", lambda: materialize(links.prepare_redlist(redlist, line), "noted"))
    timed("relink_redlist", lambda: drain(links.relink_redlist(red, merged, BINARY)))
    timed("extract_taxa", lambda: drain(checklist.extract_taxa(tables, 1, fx.PROJECTS)))
    timed("extract_synonyms", lambda: drain(checklist.extract_synonyms(tables, 1, fx.PROJECTS)))
    timed("extract_common_names", lambda: drain(checklist.extract_common_names(tables, 1, fx.PROJECTS, fx.SPECIES_LIST_DB)))
    timed("extract_redlist", lambda: drain(checklist.extract_redlist(tables, 1, fx.PROJECTS, fx.SPECIES_LIST_DB)))

    def whole_run():
        sources = staging.source_registry(spark, ["customers", "suppliers"])
        numbered = staging.number_taxa(taxa_in, collation=BINARY)
        result = merge_all(Staged(sources, numbered, synonyms, common, redlist), BINARY)
        for df in (result.taxa, result.synonyms, result.common_names, result.redlist):
            drain(df)

    timed("merge_run", whole_run)
    release(spark)
    print(
        json.dumps(
            {
                "metric": "taxonomy merge, whole run on staged tables",
                "value": seconds["merge_run"],
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
