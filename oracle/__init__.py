"""DuckDB SQL oracle: the testdata views and one SQL text per registered query."""
