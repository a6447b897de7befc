"""Jobs over tables: planning, collection, extraction, text, run log, reports."""
