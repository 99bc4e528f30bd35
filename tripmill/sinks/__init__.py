"""Writers: plain files, day-partitioned clustered tables, monthly backfill."""
