"""Column functions: everything here maps columns to columns and stays in the JVM."""
