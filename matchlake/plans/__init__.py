"""Models (star schema), parsers, reports and refresh plans."""
