"""tillmart: point-of-sale pages to typed views and marts, as Spark jobs."""
