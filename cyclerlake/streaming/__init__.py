"""Unbounded and chunked reads: conversion per micro-batch, step features across micro-batches."""
