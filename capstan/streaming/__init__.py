from capstan.streaming.snapshots import accumulate_snapshots, land_increment, read_snapshots

__all__ = ["accumulate_snapshots", "land_increment", "read_snapshots"]
