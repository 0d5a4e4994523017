"""Operators: functions from DataFrame to DataFrame that know no business rule."""
