"""Jobs that chain sources and operators: stage, dimensions, load, check, extract."""
