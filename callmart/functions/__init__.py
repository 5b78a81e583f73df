"""Column expressions: calendar, phone numbers, code decoding, rates."""
