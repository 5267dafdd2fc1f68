"""Inputs."""
