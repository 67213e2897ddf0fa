"""Explicit schemas of the stored tables (see the data model in the README)."""

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LONG, INT, SHORT, STR = T.LongType(), T.IntegerType(), T.ShortType(), T.StringType()
TS, DBL, BOOL, FLT = T.TimestampType(), T.DoubleType(), T.BooleanType(), T.FloatType()
DEC = T.DecimalType(18, 6)
STRS = T.ArrayType(STR)

POINT = _s(("x", DBL), ("y", DBL))
RING = T.ArrayType(POINT)

PARENT_JOBS = _s(
    ("id", LONG), ("name", STR), ("priority", STR), ("tile_id", STR), ("last_status_id", SHORT),
    ("last_status_change_id", LONG), ("last_status_change_date", TS),
    ("last_status_error_subtype", STR), ("error_raised", BOOL),
)
STATUS_CHANGES = _s(
    ("id", LONG), ("fk_parent_job_id", LONG), ("time", TS), ("error_subtype", STR),
    ("error_message", STR), ("job_status", SHORT),
)
OPTICAL_JOBS = _s(
    ("id", LONG), ("fk_parent_job_id", LONG), ("nrt", BOOL), ("l1c_id", STR),
    ("l1c_reference_job", BOOL), ("l1c_cloud_cover", DEC), ("l1c_snow_cover", DEC),
    ("l1c_path", STR), ("l2a_status", STR), ("run_mode", STR),
    ("n_jobs_run_since_last_init", LONG), ("n_l2a_produced_since_last_init", LONG),
    ("snow_path", STR), ("ice_path", STR), ("measurement_date", TS),
    ("source_creation_date", TS), ("source_publication_date", TS), ("hub_publication_date", TS),
    ("completion_date", TS), ("backward_reprocessing_run", BOOL), ("reprocessing_context", STR),
)
WET_SNOW_JOBS = _s(
    ("id", LONG), ("fk_parent_job_id", LONG), ("measurement_date", TS), ("radar_id_list", STRS),
    ("snow_id_list", STRS), ("assembly_id", STR), ("assembly_master_job_id", LONG),
    ("assembly_status", STR), ("snow_publication_latest_date", TS),
)
GAP_FILL_JOBS = _s(
    ("id", LONG), ("fk_parent_job_id", LONG), ("triggering_product_id", STR),
    ("triggering_product_publication_date", TS), ("input_ids", STRS), ("gap_filled_ids", STRS),
    ("product_date", TS), ("curation_timestamp", TS), ("aggregation_timespan", SHORT),
)
RADAR_ICE_JOBS = _s(
    ("id", LONG), ("fk_parent_job_id", LONG), ("scene_id", STR), ("measurement_date_start", TS),
    ("measurement_date_end", TS), ("hub_publication_date", TS), ("tile_ids", STRS),
    ("product_paths", T.MapType(STR, STR)),
)
PAIRED_ICE_JOBS = _s(
    ("id", LONG), ("fk_parent_job_id", LONG), ("process_date", TS), ("tile_id", STR),
    ("radar_paths", STRS), ("optical_paths", STRS),
)
SEASON_JOBS = _s(
    ("id", LONG), ("fk_parent_job_id", LONG), ("product_type", STR), ("tile_id", STR),
    ("first_product_measurement_date", TS), ("last_product_measurement_date", TS),
)
TEST_JOBS = _s(("id", LONG), ("fk_parent_job_id", LONG), ("name", STR))
JOB_FAMILIES = {
    "optical": OPTICAL_JOBS,
    "wet_snow": WET_SNOW_JOBS,
    "gap_filled": GAP_FILL_JOBS,
    "radar_ice": RADAR_ICE_JOBS,
    "paired_ice": PAIRED_ICE_JOBS,
    "season": SEASON_JOBS,
    "test": TEST_JOBS,
}
PRODUCTS = _s(
    ("product_id", STR), ("product_type", STR), ("mission", STR), ("tile_id", STR),
    ("version", STR), ("mode", STR), ("measurement_date", TS), ("creation_date", TS),
    ("publication_date", TS), ("cloud_cover", DBL), ("snow_cover", DBL), ("footprint", RING),
)
TILE_GRID = _s(
    ("tile_id", STR), ("epsg", INT), ("ulx", DBL), ("uly", DBL), ("lrx", DBL), ("lry", DBL)
)
FEATURE_PAGE = _s(
    (
        "features",
        T.ArrayType(
            _s(
                (
                    "properties",
                    _s(
                        ("title", STR), ("productIdentifier", STR), ("productType", STR),
                        ("cloudCover", DBL), ("snowCover", DBL), ("mission", STR),
                        ("gmlgeometry", STR), ("startDate", STR), ("completionDate", STR),
                        ("published", STR),
                    ),
                )
            )
        ),
    )
)
