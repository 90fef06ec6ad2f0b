"""tidyspark: survey and log normalisation as PySpark DataFrame jobs.

Public API (see the sub-packages for details):

* sources: ``read_csv``, ``read_table``, ``write_table``, ``write_report``,
  ``merge_into_path``, ``read_jdbc``, ``write_jdbc``, ``merge_into_jdbc``,
  ``normalize_headers``
* functions: ``text`` (cleaning) and ``parse`` (free-text parsers)
* operators: ``dense_key``, ``merge_new_rows``, ``new_rows``, vocabulary
  builders, ``lookup``, ``build_fact``, ``bridge``, ``audit`` and the reports
* plans: ``normalize_survey``, ``survey_reports``, ``survey_audit``,
  ``run_pipeline``
* streaming: ``merge_stream``
"""

from tidyspark.functions import parse, text
from tidyspark.operators.audit import audit
from tidyspark.operators.dims import (dim_from_column, dim_from_columns, dim_from_list,
                                      extract_sections, vocabulary)
from tidyspark.operators.facts import bridge, build_fact, checked_broadcast, lookup
from tidyspark.operators.keys import dense_key
from tidyspark.operators.merge import merge_new_rows, new_rows
from tidyspark.operators.reports import (count_bridge, count_by_attribute, count_distinct_by,
                                         count_distinct_by_parent, rank_by_frequency)
from tidyspark.plans.pipeline import run_pipeline
from tidyspark.plans.survey import normalize_survey, register_views, survey_audit, survey_reports
from tidyspark.session import ensure_checkpoint_dir, local_session, materialize
from tidyspark.sources.headers import normalize_headers
from tidyspark.sources.tables import (merge_into_jdbc, merge_into_path, read_csv, read_jdbc,
                                      read_table, write_jdbc, write_report, write_table)
from tidyspark.specs import ForeignKey, TableSpec, fk
from tidyspark.streaming.incremental import merge_stream

__all__ = [
    "parse", "text", "audit", "dim_from_column", "dim_from_columns", "dim_from_list",
    "extract_sections", "vocabulary", "bridge", "build_fact", "checked_broadcast", "lookup",
    "dense_key", "merge_new_rows", "new_rows", "count_bridge", "count_by_attribute",
    "count_distinct_by", "count_distinct_by_parent", "rank_by_frequency", "run_pipeline",
    "normalize_survey", "register_views", "survey_audit", "survey_reports",
    "ensure_checkpoint_dir", "local_session", "materialize", "normalize_headers",
    "merge_into_jdbc", "merge_into_path", "read_csv", "read_jdbc", "read_table", "write_jdbc",
    "write_report", "write_table", "ForeignKey", "TableSpec", "fk", "merge_stream",
]
