"""Every operator exercised on the shared test tables, with the same question in SQL."""
