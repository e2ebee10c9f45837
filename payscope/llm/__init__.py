"""Operators on training data: text, chats, web archives. Nothing outside imports them."""
