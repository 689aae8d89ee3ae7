from rollcall.sinks.csv import write_key_values, write_report, write_table

__all__ = ["write_key_values", "write_report", "write_table"]
