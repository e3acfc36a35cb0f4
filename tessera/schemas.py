"""Schemas of the internal relations."""

TILES_CSV = "Year int, X double, Y double, Y_tile int, X_tile int"
JOB = (
    "job_id string, task_type string, region string, status string, "
    "tile_info struct<year: int, lon: double, lat: double, X_tile: int, Y_tile: int>, duration_sec double, error string"
)
RUN_SUMMARY = "run_id string, step string, start_time string, n_jobs int, n_success int, n_partial int, n_failed int"
REQUEST = "map<string, map<string, struct<missing_tiles: array<string>>>>"
