"""Plans: operators wired into whole jobs (season build, request answering), the
named query catalogue and its DuckDB SQL twins."""
