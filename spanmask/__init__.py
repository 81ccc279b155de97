"""spanmask: find personal data in text columns and rewrite only those parts, on Spark."""

from .functions.recognizers import BUILTIN, DEFAULT_ENTITIES, Recognizer, get_recognizers
from .functions.rewrite import anonymize_text
from .functions.spans import SPAN_TYPE, SPANS_TYPE, detect, resolve_spans
from .operators.anonymize import anonymize, bucket_rows, scan_and_anonymize, spans_long, union_columns
from .operators.columns import full_mask, pack_result, plan_columns, result_columns
from .operators.scan import scan
from .operators.summary import summarize

__all__ = [
    "BUILTIN", "DEFAULT_ENTITIES", "Recognizer", "get_recognizers", "anonymize_text", "SPAN_TYPE",
    "SPANS_TYPE", "detect", "resolve_spans", "anonymize", "bucket_rows", "scan_and_anonymize",
    "spans_long", "union_columns", "full_mask", "pack_result", "plan_columns",
    "result_columns", "scan", "summarize",
]
