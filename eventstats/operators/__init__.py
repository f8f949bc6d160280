from eventstats.operators.columns import (
    add_fields,
    enhance_time,
    evolve,
    label_times,
    remove_fields,
    rename_replace,
    select_then_where,
    update_field,
)
from eventstats.operators.dedup import (
    drop_repeats,
    drop_seen_in_previous_batch,
    flag_duplicates,
    flag_name,
    flag_specs,
)
from eventstats.operators.formats import LogRules, format_log, format_log_basic, malformed_rows
from eventstats.operators.lookups import (
    BucketedDimension,
    Dimension,
    enrich_course,
    enrich_device,
    enrich_user,
    existence_flag,
    lookup_join,
)
from eventstats.operators.stats import StatSpec, statistics
