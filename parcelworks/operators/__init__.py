"""DataFrame operators: plain functions ``f(df, ...) -> DataFrame``."""
