"""Tables in and out: polygons, scene archives, legacy wide files, GeoParquet, reports."""
