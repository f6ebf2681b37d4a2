"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]
"""

import json
import os
import sys
import time

from seispark.catalog import registry
from seispark.session import local_session

HEADLINE = """sum_gradients gradient_norms sum_and_merge clip_quantile clip_quantile_large gradient_postprocess
cut_receiver_regions interpolate_field smooth_field station_weight geodesic_km adam_raw_update adam_apply_update
iteration_job pick_minibatch norm_percentile event_misfit job_status_counts bandpass preprocess_traces
lanczos_resample envelope cross_correlation dispersed_wavetrain sliding_xcorr contiguous_runs local_extrema
select_windows ccc_misfit adjoint_sources gabor_transform tf_phase_misfit event_processing_job latest_status
stage_readiness""".split()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    names = sys.argv[1:] or HEADLINE
    registry.QUERIES["event_misfit"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.time()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
