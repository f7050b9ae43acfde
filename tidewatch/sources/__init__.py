"""Wide fact tables in, partitioned tables out."""
