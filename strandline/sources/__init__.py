"""Readers of vocabularies, catalogs, subtitles, record files and sound."""
