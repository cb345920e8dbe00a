"""Reading tables and files, writing snapshots and layouts."""
