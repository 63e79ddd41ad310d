"""Readers and writers: event topic, ticket library, knowledge base, lanes, reports."""
