"""Spark jobs for the data side of instruction tuning and preference tuning."""

from sftframe.options import DecodeOptions, LogOptions, PreferenceOptions, SftOptions

__all__ = ["DecodeOptions", "LogOptions", "PreferenceOptions", "SftOptions"]
