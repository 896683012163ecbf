"""sinks"""
