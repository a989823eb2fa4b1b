"""Spark-native keyspace analytics: scans, predicates, aggregation, writers and streams over tables of keys.

Names are loaded when first used, so that tasks that need one module don't import all.
"""

from importlib import import_module

__version__ = "0.1.0"

_HOMES = {
    "keyharbor.functions.parse": "parsed",
    "keyharbor.operators.fields": "Field GeoField GeoShapeField NumericField TagField TextField VectorField",
    "keyharbor.operators.geo": "GeoAddResult geo_add geo_add_from_dataframe geo_dist geo_dist_matrix geo_hash geo_pos geo_radius geo_radius_by_member",
    "keyharbor.operators.keys": "DeleteResult RenameResult TtlResult delete_keys delete_keys_from_column delete_keys_pattern exists_keys get_ttl persist_keys rename_keys rename_keys_from_columns set_ttl set_ttl_from_column",
    "keyharbor.operators.query": "Context Expr col cols match_all match_none raw",
    "keyharbor.operators.search": "aggregate aggregate_hashes aggregate_json search search_hashes search_json",
    "keyharbor.sources.cache": "CacheInfo cache cache_dataframe cache_exists cache_info cache_lazy cache_ttl delete_cached get_cached_dataframe scan_cached",
    "keyharbor.sources.index": "Catalog DetectedIndex ExecutionStrategy Index IndexDiff IndexInfo QueryPlan explain_scan find_index_for_pattern list_indexes plan_query smart_scan",
    "keyharbor.sources.infer": "SchemaConfidence infer_hash_schema infer_hash_schema_with_confidence infer_hash_schema_with_overwrite infer_json_schema infer_json_schema_with_overwrite",
    "keyharbor.sources.options": "HashScanOptions HighlightOptions JsonScanOptions ListScanOptions ScanOptions SearchOptions SetScanOptions StreamScanOptions StringScanOptions SummarizeOptions TimeSeriesScanOptions ZSetScanOptions get_default_batch_size get_default_count_hint get_default_timeout_ms",
    "keyharbor.sources.scan": "KeyScanner key_info read_hashes read_json read_lists read_sets read_streams read_strings read_timeseries read_zsets scan_hashes scan_json scan_keys scan_lists scan_sets scan_streams scan_strings scan_timeseries scan_zsets",
    "keyharbor.sources.table": "Table",
    "keyharbor.sources.write": "Destination DestinationResult MultiWriteResult WriteResult write_hashes write_hashes_detailed write_hashes_multi write_json write_json_multi write_lists write_sets write_strings write_zsets",
    "keyharbor.streaming.log": "CheckpointStore ConsumerStats FileCheckpointStore Group MemoryCheckpointStore StreamConsumer TableCheckpointStore ack_entries iter_stream iter_stream_async open_log read_stream scan_stream",
    "keyharbor.streaming.pubsub": "collect_pubsub iter_pubsub iter_pubsub_async",
    "keyharbor.streaming.replication": "BatchResult ReplicationDestination ReplicationPipeline ReplicationStats field_filter",
}
_HOME = {name: home for home, names in _HOMES.items() for name in names.split()}
__all__ = sorted(_HOME)


def __getattr__(name: str):
    if name in _HOME:
        return getattr(import_module(_HOME[name]), name)
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")


def __dir__() -> list[str]:
    return [*__all__, "__version__"]
