"""lakepipe: bronze -> silver -> gold lakehouse pipelines on Spark.

Public entry points (see README.md):

* ``lakepipe.functions``            column functions (Column -> Column)
* ``lakepipe.plans.silver``         ``clean_<entity>`` jobs, ``SILVER_SPECS``
* ``lakepipe.plans.gold``           gold KPI plans, ``GOLD_JOBS``, ``run_gold``
* ``lakepipe.plans.ingest``         ``ingest_table`` / ``ingest_all`` / ``backfill``, ``WatermarkStore``
* ``lakepipe.operators``            ``dedup_latest``, ``upsert_df``, ``scd2_df``, quality gates
* ``lakepipe.sinks``                ``write_gold``, ``upsert``, ``scd2_apply``, ``append_bronze``, tables
* ``lakepipe.sources``              JDBC, bronze batch/stream readers, seeds, layout, catalog layers
* ``lakepipe.streaming``            ``run_silver_stream`` / ``run_silver_once`` / ``run_silver_tables``
"""

__version__ = "0.1.0"
