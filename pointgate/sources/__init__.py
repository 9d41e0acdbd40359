"""Readers.  File readers add ``file_path``, ``file_block`` and ``file_row``, which order records within a source."""
