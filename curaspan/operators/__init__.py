"""Table operators: DataFrame in, DataFrame out, lazy, for use with ``.transform``."""
