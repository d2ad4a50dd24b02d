"""Operators over decision logs, requests, test results and indicator feeds."""
