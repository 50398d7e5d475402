"""Bounded operators: sending, transactions, commits, delivery, record flows, statistics, tracing."""
