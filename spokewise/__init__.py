"""spokewise: file-to-table bike-share pipelines and their analytics, as Spark jobs.

Public entry points (see README.md for the statement-by-statement map):

* loads: ``Catalog``, ``copy_into``, ``truncate``, ``CsvFormat``, ``list_stage``
* unload: ``unload_json_by_day``, ``distinct_days``
* tables: ``VersionedTable`` (append, update, time travel, restore, undrop, clone)
* analytics: ``spokewise.operators.analytics``, ``weather_view``
* merge: ``stations_union``, ``merge_insert_only``
* masking: ``MaskPolicy``, ``apply_masks``
* streams: ``spokewise.streaming.ingest`` / ``consumers`` / ``observe``
"""

__version__ = "0.1.0"

_EXPORTS = {
    "Catalog": "spokewise.sources.loader",
    "copy_into": "spokewise.sources.loader",
    "truncate": "spokewise.sources.loader",
    "CsvFormat": "spokewise.sources.formats",
    "list_stage": "spokewise.sources.stage",
    "unload_json_by_day": "spokewise.sources.unload",
    "distinct_days": "spokewise.sources.unload",
    "VersionedTable": "spokewise.sources.tables",
    "weather_view": "spokewise.operators.semistructured",
    "stations_union": "spokewise.operators.merge",
    "merge_insert_only": "spokewise.operators.merge",
    "MaskPolicy": "spokewise.operators.masking",
    "apply_masks": "spokewise.operators.masking",
}


def __getattr__(name):
    """Lazy re-exports, so importing the package does not need a Spark context."""
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)


__all__ = sorted(_EXPORTS)
