"""Whole jobs: facts, summaries, reports, moderation and user labels."""
