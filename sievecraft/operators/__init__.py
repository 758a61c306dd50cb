"""Operators on tables of posts, pages, boxes, lines and queues."""
