"""Notices of licence families."""

# Wordings of public licence notices, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later "
        "version.",
        "Released under the terms of the GNU GPL v2 or later.",
    ),
    "lgpl": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it under the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS basis, without warranties or conditions of any kind.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "This work has been released into the public domain.",
        "Released under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. Unauthorized copying or distribution is strictly prohibited.",
        "This document is confidential and proprietary.",
    ),
}

# Sentences about licences that name no family.
UNKNOWN: tuple[str, ...] = (
    "See the license file for details.",
    "A valid driving license is required.",
    "The license fee is due every year.",
    "Licensed under the terms agreed with the customer.",
    "This software is licensed, not sold.",
    "Licensed under the Example Community License.",
    "Released under our own license.",
    "This work is licensed under the house rules, version 2.",
    "The rights of the public are protected by law.",
    "The general terms and conditions apply.",
    "Copyright law differs from country to country.",
    "The new version of the software was released.",
    "The file can be found in the source folder.",
    "The Apache helicopter is in use with the army.",
    "The institute is a member of the Mozilla community.",
    "Creative work is common in public schools.",
    "Permission must be obtained in writing.",
    "The source of the public notice is free to use.",
)
