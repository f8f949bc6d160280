from eventstats.plans import metrics
from eventstats.plans.flow import Flow, apply_rows_in_batches, record_udf, run_step
