"""Runnable jobs over the library's operators; each has a function that takes a session, a command line and a configuration."""
