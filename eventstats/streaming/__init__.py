from eventstats.streaming.lateness import Lateness, first_per_key
from eventstats.streaming.memory import PreviousBatch, SeenKeys
from eventstats.streaming.runner import run_stream
from eventstats.streaming.scratch import shared_dir
from eventstats.streaming.windows import latest_windows, tumbling_counts, window_counts
