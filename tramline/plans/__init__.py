"""End-to-end jobs: validations, messages, and learning from messages."""
