"""Schemas of the tables that the jobs exchange."""

from __future__ import annotations

LOG = "timestamp long, level string, location string, host string, message string"
RAW_LINE = "file string, file_ord int, offset long, line string"
MANIFEST = "topic string, first_line string, path string, size long, modified timestamp"
ARCHIVE_INDEX = "start_ts long, topic string, day string, path string, size long, recent_ts long"
TRANSFER = "timestamp long, srcip string, destip string, filesize long, tag string"
FLOW = "src string, dest string, dataflow long"
TASK_REPORT = "jobid string, task_type string, state string"
