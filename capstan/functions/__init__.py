from capstan.functions.dates import calendar_cutoff, elapsed_cutoff, previous_month_end
from capstan.functions.labels import (capacity_status, effective_status, flag_is_null_or_zero, like_any_all,
                                      model_label, program_label, task_status, ts_lit)

__all__ = ["calendar_cutoff", "elapsed_cutoff", "previous_month_end", "capacity_status", "effective_status",
           "flag_is_null_or_zero", "like_any_all", "model_label", "program_label", "task_status", "ts_lit"]
