"""The reports: operators put together, with the reports' own settings as defaults."""
