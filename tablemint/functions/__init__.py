"""Scalar functions.  Each takes and returns a Column; none needs Python at run time."""

from .compare import compare_value
from .dates import cast_as, iso_date, iso_datetime, us_datetime_to_iso
from .ids import child_path, entity_id, id_combined, project_identifier
from .labels import (
    is_wild_track,
    scene_slate,
    shoot_day_number,
    slate_full_name,
    slate_id,
    take_annotation,
    take_key,
    take_number,
    wild_track_number,
)
from .lists import join_list, named_members, split_list, split_members
from .text import (
    as_number,
    clean_text,
    ext_name,
    has_text,
    is_object_description,
    is_present,
    loose_text,
    number_or_null,
    number_text,
    positive_count,
    present,
    recorded_seconds,
    sentinel_null,
    straighten_quotes,
    trimmed,
    typed_number,
)

__all__ = [name for name in dir() if not name.startswith("_")]
