"""The reports, each a function ``(src: Sources, cfg: Config[, ...]) -> DataFrame``."""
