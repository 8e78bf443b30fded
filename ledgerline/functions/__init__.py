"""Column-level functions (keys, predicates, text, dates)."""

from ledgerline.functions.keys import (  # noqa: F401
    business_key, change_hash, entity_id, firm_id, format_uuid, key_text,
    row_key, stable_uuid,
)
from ledgerline.functions.scalar import (  # noqa: F401
    any_meaningful, any_not_null, blank_to_null, count_true, first_char_code,
    is_empty, join_array, julian_to_text, latest_change, meaningful,
    merge_lists, parse_date, rating_triple, scaled_decimal, valid_id,
    valid_name, yes_no,
)
