"""Headline timings on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS].  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tenure.config import ModelSettings, PanelSettings  # noqa: E402
from tenure.operators import cleaning, geojson, panel, spatial, survival  # noqa: E402
from tenure.operators.sampling import _checkpoint  # noqa: E402
from tenure.plans.cox_job import run_cox  # noqa: E402
from tenure.plans.logistic_job import run_logistic  # noqa: E402
from tenure.plans.panel import build_panel_parts  # noqa: E402
from tenure.plans.registry import FIXTURE_STUDY_END  # noqa: E402
from tenure.session import local_session  # noqa: E402
from tenure.sources import fixtures  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="tenure-bench", **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    lic_raw, req_raw = fixtures.licenses(spark, sf_dir), fixtures.requests(spark, sf_dir)
    lic = cleaning.clean_licenses(lic_raw)
    req = cleaning.clean_service_requests(req_raw)
    locs = panel.business_locations(lic)
    timed("radius_join", lambda: run(spatial.radius_join(locs, req, PanelSettings().radius_meters)))
    parts = timed("panel_build", lambda: build_panel_parts(lic_raw, req_raw))
    full = timed("panel_materialize", lambda: _checkpoint(parts.panel))
    settings = ModelSettings(study_end=FIXTURE_STUDY_END)
    study = survival.restrict_study_window(full, settings.study_end)
    timed("first_year_aggregate", lambda: run(survival.training_dataset(study, settings.study_end, 36, 12)))
    timed("logistic_job", lambda: run_logistic(full, settings))
    timed("cox_jobs", lambda: run_cox(full, settings))
    def geo():
        p, meta = geojson.prepare_geojson_inputs(full, fixtures.license_metadata(spark, sf_dir))
        s = geojson.business_activity_summary(p, settings.study_end)
        run(geojson.geo_feature(geojson.join_geo(s, geojson.business_license_metadata(meta))))
    timed("geojson", geo)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", "")}))


if __name__ == "__main__":
    main()
