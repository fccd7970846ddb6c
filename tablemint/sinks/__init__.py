"""Writers: table sets, entity bundles and nested JSON."""

from .bundle import bundle_parts, nested_records, write_bundle
from .tables import prune_stale, write_json, write_table_set
from .versions import clean_up, current_version, new_version, publish_version, versions

__all__ = [
    "bundle_parts", "clean_up", "current_version", "nested_records", "new_version", "prune_stale", "publish_version",
    "versions", "write_bundle", "write_json", "write_table_set",
]
