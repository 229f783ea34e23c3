"""Where events, pages and bars come from."""
