"""The jobs that users run, put together from the operators."""
