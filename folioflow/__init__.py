"""Spark jobs for social-investing data: landed captures in, typed tables out."""
