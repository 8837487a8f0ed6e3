"""The stateless log parsing on a stream of new log files."""
