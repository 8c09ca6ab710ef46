"""cosecha: Spark-native analytics for survey, food-composition and
market-price data.

Layout
------
sources/    scans and sinks (XPORT data source, zip unpack, CSV, Parquet
            stores, replace sink, store copy, ingest report)
functions/  column-level helpers (text normalisation, recoding, null-safe
            arithmetic)
operators/  DataFrame -> DataFrame operators (relational, aggregates, pivot,
            exact quantiles and bins, survey tables, statistics, fuzzy join)
plans/      the composed flows (food, prices, surveys, analyses)
"""

from cosecha.session import get_session, checkpoint_dir, materialize, scratch_path, tune

__all__ = ["get_session", "checkpoint_dir", "materialize", "scratch_path", "tune"]
