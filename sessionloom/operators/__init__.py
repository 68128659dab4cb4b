"""The analyses: functions from DataFrame to DataFrame, lazy throughout."""
