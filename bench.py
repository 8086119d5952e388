"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON."""

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

HEADLINE = ["scale_m_to_cm", "point_sample", "zonal_percentile", "floor_level_search", "burn_polygons", "floor_level_burn", "void_fill", "overview_5", "mosaic_priority", "composite_dem", "raster_blocks", "tile_neighbours"]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent}:{os.environ.get('PYTHONPATH', '')}"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from strataloom.plans.queries import QUERIES

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("scale_m_to_cm")  # starts the engine
    took = {name: round(run(name), 3) for name in HEADLINE}
    sf = folder.rstrip("/").rpartition("sf")[2]
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
