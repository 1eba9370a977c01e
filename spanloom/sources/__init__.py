"""Where spans come from: messages, the span store, and spans derived from the events table."""
