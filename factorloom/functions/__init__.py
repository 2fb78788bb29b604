"""Column builders: guarded scalars, per-ticker windows, per-day cross-sections."""
