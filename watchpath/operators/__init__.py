"""DataFrame -> DataFrame steps. Windows are keyed by (account, day)."""
