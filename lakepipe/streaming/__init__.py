from lakepipe.streaming.silver_stream import run_silver_once, run_silver_stream, run_silver_tables

__all__ = ["run_silver_once", "run_silver_stream", "run_silver_tables"]
