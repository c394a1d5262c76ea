"""Readers that turn raw files into typed tables."""
