"""Spark jobs for review corpora: building, selecting, recovering, matching and summarising."""
