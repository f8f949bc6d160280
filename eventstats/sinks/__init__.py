from eventstats.sinks.batched import BatchTable
from eventstats.sinks.bulk import BulkFiles, committed_files, read_bulk_files
from eventstats.sinks.console import print_rows
from eventstats.sinks.distinct import DistinctTable, count_states, distinct_states, merge_states
from eventstats.sinks.external import elasticsearch_options, jdbc_options, write_external
from eventstats.sinks.tally import (
    TallyTable,
    forward_changed,
    read_routed,
    typed_values,
    write_routed,
)
