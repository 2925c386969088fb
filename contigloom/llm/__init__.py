"""Operators for preparing training text: quality, duplicates, leaks, secrets, personal data, packing, pages and chats."""
