from eventstats.sources.logs import kafka_options, read_json_lines, read_log_stream, spread, union_streams
from eventstats.sources.schemas import parse_fields, schema_from_string
from eventstats.sources.tables import json_to_table, read_dimension, table_from_json
