"""Spark jobs that turn landed code-search and repository responses into tables."""
