"""Independent DuckDB SQL oracle for every registered query."""
