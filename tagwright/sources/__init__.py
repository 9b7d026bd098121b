"""Readers, writers, saved learners and shared scratch tables."""
