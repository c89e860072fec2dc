"""Public-transport analytics on Spark: ticket validations, disruption
messages and message-cause classification, as DataFrame operators."""
