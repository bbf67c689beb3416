"""Short licence notices by family, as projects and authors commonly write them.

Fixed values: the wording is what has to be recognised. ``{}`` marks a free part."""

TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache 2.0 license.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation.",
        "Released under the GPL v3 license.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Released under the LGPL v2.1 license.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL v3 license.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC0": (
        "Licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This work has been dedicated to the public domain.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Licensed under the terms of the ISC license.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Licensed under the Boost Software License 1.0.",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0.",
        "Licensed under the Eclipse Public License 2.0.",
    ),
    "Zlib": (
        "Released under the zlib license.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense license.",
    ),
    "All-rights-reserved": (
        "All rights reserved.",
        "Copyright {} {}. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the copyright owner.",
    ),
}

#: What follows the notices above in the licences' own texts and in file headers; for training only.
BODIES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful.",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions.",
    ),
}

#: Sentences with the same vocabulary that grant or reserve nothing.
OTHERS: tuple[str, ...] = (
    "He lost his driving license on the way to the station.",
    "You need a licence to fish in this river and permission from the owner.",
    "The warranty on the washing machine ran out last year.",
    "Parking by permission only, please show your permit at the desk.",
    "The copyright office opens at nine and closes at five.",
    "The law on copyright was debated in the parliament this week.",
    "The restaurant applied for a liquor license from the city.",
    "The park is in the public domain of the town, said the mayor.",
    "The table was reserved for four, all the rights and lefts were confusing.",
    "The general told the public that the foundation would be free.",
    "Drivers must renew their license every ten years.",
    "She asked for permission to redistribute the chairs in the room.",
    "A software license costs less this year than last year.",
    "The licensed plumber fixed the sink under the window.",
    "Version 2.0 of the road map was released under pressure.",
    "The commons were open to the public and the creative class.",
)

#: A piece of text without any of these stems is no candidate; every template holds one (tested).
#: Between the words of a stem there may be a line's end.
STEMS: tuple[str, ...] = ("licen", "copyright", "rights reserved", "public domain", "permission", "permitted", "redistribut")
