"""Readers: daily play logs, ratings, metadata tables and earlier results."""
