"""DataFrame operators. None of them runs a job or reads a session setting."""
