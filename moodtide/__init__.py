"""moodtide: daily news and forum sentiment analytics as Spark jobs."""

__version__ = "0.1.0"
