"""Readers of study material: captures, pasted pages, exports, transcripts, and strict rows with their problems."""
