"""Series, event-study, text-mining, validation and upsert operators as Spark plans."""
