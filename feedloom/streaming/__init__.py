"""File feeds that archive what they have read."""
