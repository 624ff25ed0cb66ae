"""Readers and writers for lines, files, tasks and existing stores."""
