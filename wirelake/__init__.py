"""wirelake: Spark jobs that plan, collect, extract, enrich and report on corporate news."""
