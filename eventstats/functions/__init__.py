from eventstats.functions.clock import (
    BUCKET_WIDTHS,
    bucket_key,
    bucket_label,
    millis_to_text,
    normalize_time,
    shift_hours,
    text_to_millis,
    time_bucket,
)
from eventstats.functions.events import (
    course_process,
    event_group,
    platform_of,
    resolve_user_id,
    resolve_user_id_strict,
)
from eventstats.functions.values import (
    blank_default,
    doc_id,
    duration_text,
    first_non_empty,
    is_blank,
    is_int32,
    json_path,
    null_to_empty,
    raw_data,
    strip_quotes,
    typed_cast,
    url_domain,
)
