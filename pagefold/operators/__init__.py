"""Stages: functions from DataFrame to DataFrame."""
